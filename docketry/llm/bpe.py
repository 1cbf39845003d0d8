"""Byte-pair encoding by a pair occurrence index, and decoding, for a vocabulary file of a public tokenizer.

The words that a batch has and the encoder does not know yet are laid out as one linked list of symbols. An index
maps each mergeable pair to all its positions there. Active ranks are applied in ascending order: a rank's
whole position list is merged in one go, and every merge adds its new neighbour pairs to the affected lists
(positions that a merge has made stale are recognised when their list is applied). So each rank is visited once per
batch, not once per word.

The file decides: Unicode NFC, white space, lower case, the split pattern, bytes as letters, an end-of-word suffix,
and special tokens whose strings are found in the raw text first. Words between white space are encoded once
and remembered; that memory is bounded by ``MEMORY_WORDS`` and never changes a result.

Letters and cases follow the tables of Python and ``regex``; letters assigned since Unicode 15.1 may differ from
the public library's tables. Its tables for NFC end at Unicode 9: marks assigned later are neither reordered nor
composed (``UNORDERED_MARKS``), which a test derives from the library again.

Results by case: a null text is an empty one; it has no ids, and decodes to the empty string. A long text is encoded whole.
Repeated rows give repeated results; an empty table gives none; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, table

VOCABULARY = "word_bpe_49k.json"
#: Remembered words of one worker; beyond it the memory starts anew.
MEMORY_WORDS = 400_000
#: Words that one index takes at once.
INDEX_WORDS = 300_000
#: From so many positions on, a rank's list is merged as arrays.
ARRAY_FROM = 24

#: White space as the file's patterns mean it (Unicode White_Space).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The combining marks, and one vowel sign (U+11930), that the library's normalisation takes for
#: characters which neither move nor compose.
UNORDERED_MARKS = (
    "\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c"
    "\U00010d24-\U00010d27\U00010eab\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85"
    "\U00011070\U0001133b\U0001145e\U00011839\U0001183a\U00011930\U0001193d\U0001193e\U00011943\U000119e0"
    "\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44\U00011d45\U00011d97\U00011f41\U00011f42"
    "\U00016ff0\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef"
)
NORMALISED_PARTS = regex.compile(f"[^{UNORDERED_MARKS}]+")


def composed(text: str) -> str:
    """NFC by the library's tables: the parts between marks that it doesn't know are normalised apart."""
    if text.isascii():
        return text
    return NORMALISED_PARTS.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte: itself where printable, else the next one from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in keep}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(0x100 + n)
    return letters


class Index:
    """Positions of each mergeable pair, by the pair's rank, and the ranks that have any."""

    def __init__(self, encoder: Encoder, symbol: np.ndarray, after: np.ndarray):
        self.keys, self.ranks = encoder.rank_keys, encoder.rank_of
        self.single: dict[int, list[int]] = {}
        self.many: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        left = np.flatnonzero(after >= 0)
        self.add_all(symbol[left] * encoder.width + symbol[left + 1], left)

    def add(self, rank: int, place: int) -> None:
        if rank in self.single:
            self.single[rank].append(place)
        else:
            self.single[rank] = [place]
            if rank not in self.many:
                heapq.heappush(self.active, rank)

    def add_all(self, pairs: np.ndarray, places: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        has = self.keys[at] == pairs
        ranks, places = self.ranks[at[has]], places[has]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, s, e in zip(ranks[[0, *cuts]].tolist() if len(ranks) else (), [0, *cuts], [*cuts, len(ranks)], strict=False):
            if rank in self.many:
                self.many[rank].append(places[s:e])
            else:
                self.many[rank] = [places[s:e]]
                if rank not in self.single:
                    heapq.heappush(self.active, rank)

    def lowest(self) -> int | None:
        return heapq.heappop(self.active) if self.active else None

    def take(self, rank: int) -> np.ndarray:
        found = self.many.pop(rank, [])
        if rank in self.single:
            found.append(np.array(self.single.pop(rank), np.int64))
        return found[0] if len(found) == 1 else np.concatenate(found)


class Encoder:
    """Word-level encoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + self.suffix] for b in range(256)], np.int64)
        self.width = max(self.tokens) + 1
        #: pair -> rank, and by rank its left, right and merged symbol
        self.rank: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank[vocab[a] * self.width + vocab[b]] = rank
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
        born = {new: r for r, (_, _, new) in reversed(list(enumerate(self.merges)))}
        if any(born.get(a, -1) >= r or born.get(b, -1) >= r for r, (a, b, _) in enumerate(self.merges)):
            raise ValueError("a merge comes before the merges that make its parts")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", SPACE))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.spaces = regex.compile(f"[^{SPACE}]+")
        self.pieces_or_end = regex.compile(self.pieces.pattern + "|\n")
        #: what is remembered of a word: its ids as bytes
        self.ids: dict[str, bytes] = {}
        self.rank_keys = np.array(sorted(self.rank), np.int64)
        self.rank_of = np.array([self.rank[k] for k in self.rank_keys.tolist()], np.int64)

    def lowered(self, text: str) -> str:
        text = composed(text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def words(self, text: str) -> list[str]:
        """The parts between white space; no later step looks across it."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.spaces.findall(text)
        return text.split()

    def index_and_merge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and where each piece's ids end; one index for all pieces."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        flat = np.frombuffer(b"".join(data), np.uint8)
        size = len(flat)
        symbol = self.inner[flat]
        symbol[ends - 1] = self.last[flat[ends - 1]]
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1] = -1
        before[0], before[ends[:-1]] = -1, -1

        index = Index(self, symbol, after)
        # The same memory: arrays for long lists of positions, single items for short ones.
        one_symbol, one_after, one_before = memoryview(symbol), memoryview(after), memoryview(before)
        width, rank, add = self.width, self.rank.get, index.add
        while (r := index.lowest()) is not None:
            a, b, new = self.merges[r]
            here = index.take(r)
            if a != b and len(here) >= ARRAY_FROM:
                here = np.unique(here)
                here = here[(symbol[here] == a) & (after[here] >= 0)]
                here = here[symbol[after[here]] == b]
                right = after[here]
                symbol[here], symbol[right] = new, -1
                beyond = after[here] = after[right]
                has = beyond >= 0
                before[beyond[has]] = here[has]
                index.add_all(new * width + symbol[beyond[has]], here[has])
                left = before[here]
                left = left[left >= 0]
                index.add_all(symbol[left] * width + new, left)
                continue
            for p in sorted(set(here.tolist())):
                q = one_after[p]
                if one_symbol[p] != a or q < 0 or one_symbol[q] != b:
                    continue
                one_symbol[p], one_symbol[q] = new, -1
                n = one_after[p] = one_after[q]
                if n >= 0:
                    one_before[n] = p
                    if (r2 := rank(new * width + one_symbol[n])) is not None:
                        add(r2, p)
                o = one_before[p]
                if o >= 0 and (r2 := rank(one_symbol[o] * width + new)) is not None:
                    add(r2, o)
        alive = symbol >= 0
        return symbol[alive], np.cumsum(alive)[ends - 1]

    def learn(self, words: list[str]) -> None:
        """Adds these words, each with its ids as bytes."""
        parts: list[list[str]] = []
        plain = words
        if self.special and any("<|" in w for w in words):
            plain = []
            for word in words:
                if self.specials.search(word):
                    self.learn_special(word)
                else:
                    plain.append(word)
        own: list[str] = []
        # No piece holds a line feed, so the words can be lowered and cut as one text.
        for piece in self.pieces_or_end.findall(self.lowered("\n".join(plain)) + "\n" if plain else ""):
            if piece == "\n":
                parts.append(own)
                own = []
            else:
                own.append(piece)
        fresh = list({x: None for own in parts for x in own})
        if fresh:
            ids, ends = self.index_and_merge(fresh)
            raw = ids.astype("<u4").tobytes()
            ends = ends.tolist()
            starts = [0, *ends[:-1]]
            coded = {x: raw[4 * s : 4 * e] for x, s, e in zip(fresh, starts, ends, strict=True)}
        for word, own in zip(plain, parts, strict=True):
            self.ids[word] = coded[own[0]] if len(own) == 1 else b"".join([coded[x] for x in own])

    def learn_special(self, word: str) -> None:
        """A word that holds strings of special tokens: what lies between them is encoded by itself."""
        ids, at = [], 0
        for m in [*self.specials.finditer(word), None]:
            between = word[at : m.start() if m else len(word)]
            if between:
                self.learn([between])
                ids.append(self.ids[between])
            if m:
                ids.append(np.array([self.special[m[0]]], "<u4").tobytes())
                at = m.end()
        self.ids[word] = b"".join(ids)

    def joined(self, words: list[str]) -> tuple[bytes, str]:
        """The ids of the words, and what ``decode`` makes of these ids."""
        ids = b"".join(map(self.ids.__getitem__, words))
        return ids, decode(ids, self.tokens)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text.

        Unknown words are learned for a run of texts at a time, which ends at ``INDEX_WORDS`` of them.
        """
        run: list[list[str]] = []
        unknown: dict[str, None] = {}

        def flush() -> Iterator[tuple[bytes, str]]:
            self.learn(list(unknown))
            for words in run:
                yield self.joined(words)
            run.clear()
            unknown.clear()
            if len(self.ids) > MEMORY_WORDS:
                self.ids.clear()

        for text in texts:
            words = self.words(text) if text else []
            run.append(words)
            unknown.update((w, None) for w in words if w not in self.ids)
            if len(unknown) >= INDEX_WORDS:
                yield from flush()
        yield from flush()


def decode(ids: bytes, tokens: dict[int, str]) -> str:
    """The tokens with a space between them: the file names no decoder."""
    return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of each row: ids as binary, little-endian unsigned 32-bit. No shuffle."""

    @arrow_udf("ids binary, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for texts in batches:
            yield pd.DataFrame(list(own.encode(texts.tolist())), columns=["ids", "decoded"])

    found = docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text)).alias("found"))
    return found.select("doc_id", "found.ids", "found.decoded")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode``, with number of tokens and digests in place of the ids and the decoded text."""

    @arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for texts in batches:
            rows = [
                (
                    len(ids) // 4,
                    hashlib.sha256(ids).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                )
                for ids, decoded in own.encode(texts.tolist())
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text)).alias("found"))
    return found.select("doc_id", "found.*")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary_path())


QUERIES = {"op2_bpe": op2_bpe}
ORACLES: dict[str, str] = {}
