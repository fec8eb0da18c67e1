"""BPE encoding and decoding: propose greedily, verify adjacent pairs, merge exactly where that fails.

For each new word the longest tokens from left to right are a proposal. It is the encoding if every
token encodes to itself and every two neighbours, put together, encode to just these two: then no
merge ever crosses a border. Both facts are kept by token and by pair; the pairs of all new words of
a part are looked up at once as sorted numbers, and only unknown pairs are worked out. Words with a
failing pair are merged by rank around that border: what the letters of its two tokens merge to takes
their place, and is learned for all words, until all neighbours fit, which makes it the encoding. Words
that do not come to rest are merged whole. Known words and pairs are kept in tables of bounded size.

The tokenizer is the content of a JSON file of the tokenizers library, read on the driver and sent
to tasks. Supported are BPE models with byte-level characters, an end-of-word suffix, a split
pattern that keeps its matches and the normalizers NFC, white space to a space, lower case; anything
else is an error. As the pattern matches no white space, replacing white space changes nothing and
is left out. Words are split with Python's tables of characters; only a text with characters that
these do not know is split by the library itself. A decoder of null joins tokens with one space.

Defined results: a null or empty text has no tokens, and the digests are those of the empty string;
repeated rows each give a row; an empty table gives an empty result; further columns are not read. No text is cut, whatever its length.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tagweave.llm.common import slices

KNOWN_WORDS, KNOWN_PAIRS, PART_BYTES, SHORT = 200_000, 1_000_000, 4_000_000, 64
#: Pairs whose exact merging is kept, and how often a word is mended before it is merged whole.
REMADE, MENDED = 300_000, 16


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where it is printable, else the next beyond 255."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    moved = iter(range(256, 512))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class WordBpe:
    """Encodes texts by one tokenizer; keeps what it has learned about words, tokens and pairs."""

    def __init__(self, spec: str):
        self.spec, self.library, self.sure = spec, None, set(map(chr, range(128)))
        spec = json.loads(spec)
        model, split = spec["model"], spec["pre_tokenizer"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = [p["type"] for p in split.get("pretokenizers", [])]
        fine = model["type"] == "BPE" and model["end_of_word_suffix"] and not model["ignore_merges"] and not model["byte_fallback"]
        fine = fine and kinds == ["NFC", "Replace", "Lowercase"] and steps == ["Split", "ByteLevel"] and spec["decoder"] is None
        fine = fine and not model["dropout"] and not model["continuing_subword_prefix"] and spec["post_processor"] is None
        if not fine:
            raise ValueError("this kind of tokenizer is not supported")
        self.end = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.words = regex.compile(split["pretokenizers"][0]["pattern"]["Regex"]).findall
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.letters = byte_letters()
        self.name = {v: k for k, v in self.ids.items()}
        self.longest = max(map(len, self.ids))
        #: The longest token inside a word that begins with three letters.
        self.reach: dict[str, int] = {}
        for name in self.ids:
            if not name.endswith(self.end):
                self.reach[name[:3]] = max(len(name), self.reach.get(name[:3], 0))
        self.of_byte = dict(enumerate(self.letters))
        self.number = {i: str(i) for i in self.name}
        self.known = {token: (str(i), token) for token, i in special.items()}  # a word never equals one of these
        self.fixed = dict(self.known)
        self.stable: dict[int, bool] = {}
        self.pairs = np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)
        self.remade: dict[int, tuple[int, ...]] = {}
        self.exact = 0

    def symbols(self, word: str) -> list[str]:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.end
        return letters

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: the best ranked pair, the leftmost of equal ones, until no pair has a rank."""
        if len(symbols) > SHORT:
            return self._merge_long(symbols)
        rank, none = self.rank.get, len(self.rank)
        symbols = list(symbols)
        ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((symbols[k - 1], symbols[k]), none)
            if k < len(ranks):
                ranks[k] = rank((symbols[k], symbols[k + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of pairs, for words without end."""
        left, right = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        symbols = list(symbols)
        heap = [(self.rank[p], k, *p) for k, p in enumerate(zip(symbols, symbols[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            after = right[k]
            if symbols[k] != a or after < 0 or symbols[after] != b:
                continue  # one of the two has been merged since
            symbols[k], symbols[after] = a + b, ""
            right[k] = right[after]
            if right[k] >= 0:
                left[right[k]] = k
            for x, y in ((left[k], k), (k, right[k])):
                pair = (symbols[x], symbols[y]) if x >= 0 and y >= 0 else None
                if pair in self.rank:
                    heapq.heappush(heap, (self.rank[pair], x, *pair))
        return [x for x in symbols if x]

    def _letters_of(self, token: int) -> list[str]:
        name = self.name[token]
        if name.endswith(self.end):
            name = name[: -len(self.end)]
            return [*name[:-1], name[-1:] + self.end]
        return list(name)

    def _is_stable(self, token: int) -> bool:
        if token not in self.stable:
            self.stable[token] = self.merge(self._letters_of(token)) == [self.name[token]]
        return self.stable[token]

    def _fit(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        if not (self._is_stable(left) and self._is_stable(right)) or self.name[left].endswith(self.end):
            return False
        return self.merge(self._letters_of(left) + self._letters_of(right)) == [self.name[left], self.name[right]]

    def _remake(self, pair: int) -> tuple[int, ...]:
        """What the letters of two neighbours merge to, themselves if they fit; empty where that is no token."""
        found = self.merge(self._letters_of(pair >> 32) + self._letters_of(pair & 0xFFFFFFFF))
        made = tuple(self.ids[s] for s in found) if all(s in self.ids for s in found) else ()
        self.remade[pair] = made
        return made

    def mend(self, tokens: list[int]) -> list[int] | None:
        """The encoding, found by merging around borders that do not fit; None where it is not found soon."""
        tokens, at, left = list(tokens), 0, MENDED
        known = self.remade.get
        while at < len(tokens) - 1:
            pair = tokens[at] << 32 | tokens[at + 1]
            made = known(pair)
            if made is None:
                made = self._remake(pair)
            if len(made) == 2 and made[0] == tokens[at]:
                at += 1
                continue
            left -= 1
            if not (made and left):
                return None
            tokens[at : at + 2] = made
            at = max(at - 1, 0)
        return tokens

    def propose(self, word: str) -> list[int]:
        """Longest tokens from the left; -1 where none fits."""
        letters = word if word.isalpha() and word.isascii() else word.encode().decode("latin-1").translate(self.of_byte)
        found, at, ids, end, reach = [], 0, self.ids.get, self.end, self.reach.get
        last, near = len(letters) - 1, len(letters) + len(self.end) - self.longest
        while at <= last:
            token = ids(letters[at:] + end) if at >= near else None
            if token is not None:
                found.append(token)
                break
            for stop in range(min(last, at + reach(letters[at : at + 3], 2)), at, -1):
                token = ids(letters[at:stop])
                if token is not None:
                    break
            if token is None:
                return [-1]
            found.append(token)
            at = stop
        return found

    def learn(self, words: list[str]) -> None:
        """Encodes new words: proposals of all of them, then one check of all their pairs."""
        proposed = [self.propose(w) for w in words]
        sizes = np.array([len(p) for p in proposed], np.int64)
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        joined = owner[1:] == owner[:-1]
        pairs = ((flat[:-1] << 32) | np.maximum(flat[1:], 0))[joined]
        wrong = np.zeros(len(words), bool)
        wrong[owner[flat < 0]] = True
        alone = np.flatnonzero(sizes == 1)
        for k in alone:
            wrong[k] |= flat[owner.searchsorted(k)] < 0 or not self._is_stable(proposed[k][0])
        unknown = np.setdiff1d(pairs, self.pairs)
        if len(unknown):
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
                unknown = np.unique(pairs)
            codes = np.concatenate([self.pairs, unknown])
            fits = np.concatenate([self.fits, np.fromiter((self._fit(int(p)) for p in unknown), bool, len(unknown))])
            order = np.argsort(codes)
            self.pairs, self.fits = codes[order], fits[order]
        if len(pairs):
            fit = self.fits[np.searchsorted(self.pairs, pairs)]
            wrong[owner[1:][joined][~fit]] = True
        number, name = self.number, self.name
        for k, word in enumerate(words):
            tokens = proposed[k]
            if wrong[k]:
                self.exact += 1
                tokens = self.mend(tokens) if len(tokens) > 1 and tokens[-1] >= 0 else None
                if tokens is None:
                    tokens = [self.ids[s] for s in self.merge(self.symbols(word)) if s in self.ids]
            self.known[word] = " ".join([number[t] for t in tokens]), " ".join([name[t] for t in tokens])

    def unsure(self, text: str) -> bool:
        """Does a text have a character without a category in Python's tables?"""
        fresh = set(text) - self.sure
        self.sure |= {c for c in fresh if unicodedata.category(c) != "Cn"}
        return not fresh <= self.sure

    def _split_by_library(self, text: str) -> list[str]:
        """Words of a text with characters that Python's tables do not know yet, whose case and kind may have changed."""
        if self.library is None:
            self.library = Tokenizer.from_str(self.spec)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        byte = {letter: b for b, letter in enumerate(self.letters)}
        return [bytes(byte[c] for c in piece).decode() for piece, _ in pieces]

    def split(self, text: str) -> list[str]:
        """The words of a text after normalizing, and special tokens as they are."""
        pieces = self.special.split(text) if self.special and "<" in text else [text]
        words: list[str] = []
        for k, piece in enumerate(pieces):
            if k % 2:
                words.append(piece)
            elif not piece.isascii() and self.unsure(piece):
                words += self._split_by_library(piece)
            elif piece:
                plain = piece if piece.isascii() else unicodedata.normalize("NFC", piece).replace("Σ", "σ")
                words += self.words(plain.lower())
        return words

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text its ids and its tokens, each joined by one space."""
        split = [self.split(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known = dict(self.fixed)
        if len(self.remade) > REMADE:
            self.remade = {}
        self.learn([w for w in set().union(*split) if w not in self.known])
        known = self.known
        found = []
        for words in split:
            both = [known[w] for w in words]
            found.append((" ".join([b[0] for b in both if b[0]]), " ".join([b[1] for b in both if b[0]])))
        return found


_ready: dict[str, WordBpe] = {}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _encoder(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = _sha(spec.value)
        if key not in _ready:
            _ready.clear()
            _ready[key] = WordBpe(spec.value)
        for whole in batches:
            for batch in slices(whole, "text", PART_BYTES):
                found = _ready[key].encode([t or "" for t in batch.column(1).to_pylist()])
                count = [ids.count(" ") + 1 if ids else 0 for ids, _ in found]
                columns = [pa.array(count, pa.int64()), *(pa.array([f[k] for f in found], pa.large_string()) for k in (0, 1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids", "decoded"])

    return run


def _digester(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encoder(spec)(batches):
            digests = [pa.array([_sha(t) for t in batch.column(k).to_pylist()], pa.string()) for k in (2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *digests], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _spec(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:  # on the driver; a vocabulary has a fixed size
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _with_id(docs: DataFrame, columns: str) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the ids and the decoded text as strings."""
    schema = _with_id(docs, "n_tokens long, ids string, decoded string")
    return docs.select("doc_id", "text").mapInArrow(_encoder(_spec(docs, path)), schema)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded text."""
    schema = _with_id(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", "text").mapInArrow(_digester(_spec(docs, path)), schema)
