"""Language identification by compression: a text belongs to the language whose sample compresses it best.

Each language has one zstandard raw-content dictionary, cut from a bounded sample of labelled texts: of the
``SAMPLE_DOCS`` texts whose ids hash lowest, ``SAMPLE_BYTES`` at most of each, ``DICTIONARY_BYTES`` in all. A longer
text gives ``PIECES`` pieces, one from each part of it, at a place that the text's hash picks: a shared header gets no
more of the dictionary than its share of the text, and equal texts still count once. A
text is compressed whole, once per dictionary, in frames of ``FRAME_BYTES`` each: every frame sees the dictionary
and not what the text itself repeats. The smallest sum names the language. Its lead over the next one, in bits per
byte of text, is the margin; below ``MIN_MARGIN`` the answer is rejected. Case is folded and all ASCII characters but
letters count as spaces, in samples and texts alike: they tell no language.

Defined results: a null text and a text without a letter are ``und`` with score 0 and rejected. Equal sizes go to
the language whose name comes first (margin 0, rejected). Without any labelled text every language is ``und``; with
one language only, that one is the answer with score 1 and is not rejected. Repeated rows are answered alike; an empty
table gives an empty result; columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import arrow_udf, held_out, keep_rows, table

SAMPLE_DOCS = 256
SAMPLE_BYTES = 1024
PIECES = 4
DICTIONARY_BYTES = 112 * 1024
FRAME_BYTES = 1024
LEVEL = 7
#: Bits per byte that the best language must save over the next one.
MIN_MARGIN = 0.02
UNKNOWN = "und"


#: Bytes of a piece; a line feed stands between two.
PIECE_BYTES = (SAMPLE_BYTES - PIECES + 1) // PIECES


def pieces(text: Column) -> Column:
    """A text of at most ``SAMPLE_BYTES`` bytes as it is, of a longer one a piece from each of ``PIECES`` equal parts."""
    part = F.floor(F.length(text) / PIECES).cast("int")
    size = F.least(part, F.lit(PIECE_BYTES))
    places = [
        (F.lit(k) * part + F.pmod(F.xxhash64(text, F.lit(k)), (part - size + 1).cast("long"))).cast("int") + 1
        for k in range(PIECES)
    ]
    spread = F.array(*[F.substring(text, at, size) for at in places])
    return F.when(F.octet_length(text) <= SAMPLE_BYTES, F.array(text)).otherwise(spread)


def learn_dictionaries(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> dict[str, bytes]:
    """Language -> raw content. Reads the rows where ``learn`` is true and language and text are not null.

    Only the sample reaches the driver, ``DICTIONARY_BYTES`` for each language. The window keeps the lowest hashes of
    each input partition before anything is shuffled.
    """
    key = F.xxhash64(F.col(doc_id))
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), key.alias("key"), F.col(doc_id).alias("doc_id"), pieces(F.col(text)).alias("text")
    )
    lowest = Window.partitionBy("lang").orderBy("key", "doc_id", "text")
    sample = rows.withColumn("place", F.row_number().over(lowest)).filter(F.col("place") <= SAMPLE_DOCS)
    found: dict[str, list[tuple[int, bytes]]] = {}
    for r in sample.select("lang", "place", "text").toLocalIterator():
        most = SAMPLE_BYTES if len(r["text"]) == 1 else PIECE_BYTES
        found.setdefault(r["lang"], []).append((r["place"], b"\n".join([letters(p)[:most] for p in r["text"]])))
    out = {}
    for lang_name, parts in sorted(found.items()):
        distinct = list(dict.fromkeys(p for _, p in sorted(parts)))
        out[lang_name] = b"\n".join(distinct)[:DICTIONARY_BYTES]
    return out


_LETTERS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def letters(text: str) -> bytes:
    """Lower case; every ASCII character but letters is a space."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS)


class Models:
    """One compressor per language, with its dictionary digested once."""

    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...], level: int):
        self.names = [name for name, _ in dictionaries]
        self.compressors = []
        for _, content in dictionaries:
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=level, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def answer(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)"""
        if not self.names or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, True
        data = letters(text)
        frames = [data[i : i + FRAME_BYTES] for i in range(0, len(data), FRAME_BYTES)]
        sizes = [sum(len(c.compress(f)) for f in frames) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0, 8.0, False
        lead = min(s for i, s in enumerate(sizes) if i != best) - sizes[best]
        margin = 8.0 * lead / len(data)
        # Sizes are code lengths: each bit that another language needs more halves its share. The exponent is
        # bounded, so that the rounding of sizes to whole bytes does not claim certainty.
        shares = np.exp2(-np.minimum(8.0 * (np.array(sizes) - sizes[best]), 60.0) / 4.0)
        return self.names[best], float(1.0 / shares.sum()), margin, margin < MIN_MARGIN


@lru_cache(maxsize=2)
def models(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> Models:
    return Models(dictionaries, level)


def predict(text: Column, dictionaries: Mapping[str, bytes], level: int = LEVEL) -> Column:
    """struct<lang_pred, score, margin, rejected> of a text column."""
    content = tuple(sorted(dictionaries.items()))

    @arrow_udf("lang_pred string, score double, margin double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = models(content, level)
        for texts in batches:
            rows = [own.answer(t) for t in texts.tolist()]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "margin", "rejected"])

    return run(text)


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, rejected); learned from the rows that aren't held out."""
    out = held_out("doc_id", folds, fold)
    dictionaries = learn_dictionaries(docs, ~out)
    found = docs.select("doc_id", out.alias("held_out"), predict(F.col("text"), dictionaries).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def keep_identified(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """The rows of ``docs`` whose language is told with a sufficient margin."""
    dictionaries = learn_dictionaries(docs, ~held_out("doc_id", folds, fold))
    return keep_rows(docs, ~predict(F.col("text"), dictionaries)["rejected"])


def op7_zstd_language(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op7_zstd_language": op7_zstd_language}
ORACLES: dict[str, str] = {}
