"""Quality rules from a public tokenizer: characters per token, byte-fallback share and token entropy, with a band
for each script; before them, base rules from counts of words, symbols, repeated lines and repeated windows.

Words are encoded with a byte-fallback vocabulary, each behind its word mark, as in running text; a word is
encoded once per worker and remembered (``MEMORY_WORDS`` at most; that changes no result). All counts run over the
whole text.

A null text has no words and is an empty one: all counts 0, ``base_failed`` true, ``kept`` false. Rows are judged
one by one, repeated rows alike; columns other than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import WORD, arrow_udf, table

VOCABULARY = "piece_bpe_32k.model"
MEMORY_WORDS = 400_000

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: First code point of each block that decides a script, and the script from there on.
SCRIPT_BLOCKS = (
    (0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"), (0x007B, "other"),
    (0x00C0, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "other"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "indic"), (0x0E00, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
)


@dataclass(frozen=True)
class Band:
    """A text is kept within all of these. ``min_entropy`` is in bits per token and holds from
    ``entropy_from`` tokens on: a short text can't have much."""

    min_chars: float
    max_chars: float
    max_byte_share: float
    min_entropy: float
    entropy_from: int = 64


#: By the script that most letters of a text have; ``other`` also where there is no letter.
BANDS: Mapping[str, Band] = {
    "latin": Band(1.4, 8.0, 0.10, 4.0),
    "greek": Band(0.5, 6.0, 0.30, 3.0),
    "cyrillic": Band(0.8, 7.0, 0.20, 3.5),
    "hebrew": Band(0.4, 6.0, 0.50, 3.0),
    "arabic": Band(0.4, 6.0, 0.50, 3.0),
    "indic": Band(0.2, 6.0, 0.90, 3.0),
    "kana": Band(0.3, 6.0, 0.80, 3.0),
    "han": Band(0.3, 6.0, 0.80, 3.0),
    "hangul": Band(0.3, 6.0, 0.80, 3.0),
    "other": Band(0.2, 8.0, 0.90, 3.0),
}

COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, script string, n_tokens bigint, chars_per_token double, byte_share double, "
    "token_entropy double, kept boolean"
)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of so many words which the text holds at least twice, each counted once.

    Equal windows get equal numbers by doubling: a window of 2, 4 and 8 words is a pair of windows of half its
    length, so nothing is hashed.
    """
    n = len(words)
    if n <= window:
        return 0
    rank, size = words.astype(np.int64), 1
    while size < window:
        pairs = rank[:-size] * n + rank[size:]
        rank = np.unique(pairs, return_inverse=True)[1]
        size *= 2
    if len(counts := np.bincount(rank)) == len(rank):
        return 0
    starts = np.flatnonzero(counts[rank] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def script_of(text: str) -> str:
    """The script of most letters; of equally many, the one that comes first in ``BANDS``."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "other"
    starts = np.array([b[0] for b in SCRIPT_BLOCKS], np.uint32)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(np.searchsorted(starts, points, side="right") - 1, minlength=len(starts))
    total = dict.fromkeys(BANDS, 0)
    for (_, name), n in zip(SCRIPT_BLOCKS, counts.tolist(), strict=True):
        total[name] += n
    del total["other"]
    best = max(total, key=total.get)
    return best if total[best] else "other"


class PieceCounter:
    """Numbers of pieces of single words under a byte-fallback vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        if len(self.place) > MEMORY_WORDS:
            self.clear()
        words = [w for w in dict.fromkeys(words) if w not in self.place]
        if not words:
            return
        found = self.model.encode(words, num_threads=1)
        at = len(self.place)
        self.place.update(zip(words, range(at, at + len(words)), strict=True))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def tokens(self, places: np.ndarray) -> np.ndarray:
        """Token ids of these words in order."""
        start, size = self.starts[places], self.starts[places + 1] - self.starts[places]
        total = int(size.sum())
        if not total:
            return self.ids[:0]
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.ids[np.arange(total) + shift]


@lru_cache(maxsize=1)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def measure(text: str, words: list[str], pieces: PieceCounter, bands: Mapping[str, Band]) -> tuple:
    places = np.fromiter(map(pieces.place.__getitem__, words), np.int64, len(words))
    n_words, word_chars = len(words), len(text) - sum(map(text.count, BLANKS))
    symbols, lines = sum(map(text.count, SYMBOLS)), duplicate_lines(text)
    local = np.unique(places, return_inverse=True)[1] if n_words > WINDOW else places
    repeated = repeated_words(local)
    failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n_words
    tokens, script = pieces.tokens(places), script_of(text)
    n = len(tokens)
    if n:
        counts = np.bincount(tokens)
        counts = counts[counts > 0]
        chars, byte_share = word_chars / n, float(pieces.is_byte[tokens].sum()) / n
        entropy = float(np.log2(n) - (counts * np.log2(counts)).sum() / n)
    else:
        chars, byte_share, entropy = 0.0, 0.0, 0.0
    band = bands[script]
    good = band.min_chars <= chars <= band.max_chars and byte_share <= band.max_byte_share
    good = good and (n < band.entropy_from or entropy >= band.min_entropy)
    return (
        n_words, word_chars, symbols, lines, repeated, failed, script, n, chars, byte_share, entropy,
        good and not failed,
    )


def judge(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", bands: Mapping[str, Band] = BANDS
) -> DataFrame:
    """(doc_id, ...) of each row with all counts, measures and the verdict ``kept``. No shuffle."""
    names = [c.strip().split(" ")[0] for c in COLUMNS.split(",")]

    @arrow_udf(COLUMNS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = counter(path)
        for texts in batches:
            rows = []
            whole = [t or "" for t in texts.tolist()]
            for at in range(0, len(whole), 512):
                part = whole[at : at + 512]
                words = [WORD.findall(t) for t in part]
                pieces.learn(list({w: None for own in words for w in own}))
                rows += [measure(t, w, pieces, bands) for t, w in zip(part, words, strict=True)]
            yield pd.DataFrame(rows, columns=names)

    found = docs.select(F.col(doc_id).alias("doc_id"), run(F.col(text)).alias("found"))
    return found.select("doc_id", "found.*")


def op5_fertility(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return judge(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op5_fertility": op5_fertility}
ORACLES: dict[str, str] = {}
