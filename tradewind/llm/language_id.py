"""Language identification by compression.

For each language a bounded sample of its labelled documents is a raw-content dictionary of zstandard. A text is cut into pieces of
about ``PIECE`` bytes, every piece is compressed with each dictionary, and the language with the least bytes over the
whole text wins. Case is folded first. The piece is short next to the dictionary, so that the dictionary and not the text itself decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import crc_bucket
from tradewind.operators.topk import top_per_group

FOLDS = 5
#: Of each language so many documents, and of each so many characters, make the dictionary.
SAMPLE_DOCUMENTS = 64
SAMPLE_CHARS = 600
PIECE = 4096
#: Margin between the best and the second language, as a share of the second, under which a verdict is rejected.
MARGIN = 0.01
NONE = "und"


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """The dictionary of each language, from rows with text and lang outside fold 0: at most SAMPLE_DOCUMENTS of each.

    The documents are those whose hashes are least, so the sample does not depend on the order or place of the rows.
    """
    labelled = docs.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        crc_bucket("doc_id", FOLDS).alias("fold"),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("mix"),
    ).where("fold <> 0 and text is not null and lang is not null and text <> ''")
    sample = top_per_group(labelled, ["lang"], ["mix", "text"], SAMPLE_DOCUMENTS)
    out: dict[str, list[str]] = {}
    # the part in the middle: beginnings are more alike than the rest
    part = F.substring("text", F.greatest(F.lit(1), (F.length("text") / 2 - SAMPLE_CHARS // 2).cast("int")), F.lit(SAMPLE_CHARS))
    for row in sample.select("lang", "mix", part.alias("part")).orderBy("lang", "mix", "part").toLocalIterator():
        out.setdefault(row["lang"], []).append(row["part"])
    return {lang: "\n".join(parts).lower().encode() for lang, parts in out.items()}


class Compressors:
    """One compressor for each language, and their verdict on a text."""

    def __init__(self, contents: dict[str, bytes]):
        self.langs = sorted(contents)
        self.compressors = []
        # three-byte matches: in short texts most words are no longer than that
        settings = zstandard.ZstdCompressionParameters(
            window_log=17,
            chain_log=15,
            hash_log=15,
            search_log=3,
            min_match=3,
            target_length=32,
            strategy=zstandard.STRATEGY_LAZY2,
            write_content_size=False,
            write_dict_id=False,
        )
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=content))

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c.compress(piece)) for piece in pieces) for c in self.compressors]

    def verdict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin); the least name wins a tie."""
        if not text or not self.langs or not any(c.isalpha() for c in text):
            return NONE, 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = order[0]
        if len(order) == 1:
            return self.langs[best], 1.0, 1.0
        second = sizes[order[1]]
        margin = (second - sizes[best]) / second
        return self.langs[best], min(1.0, 0.5 + 5 * margin), margin


def predicted(docs: DataFrame, contents: dict[str, bytes]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, rejected) for every row of ``docs``.

    lang_pred is the closest learned language, ``und`` for a null text, one without a letter, or if nothing was learned.
    score is 0 to 1 and grows with the margin; rejected marks margins under ``MARGIN``, and all ``und``. held_out is
    whether crc32(doc_id as text) mod 5 is 0 (null for a null doc_id). Only the text is an input of the prediction.
    """
    held = docs.sparkSession.sparkContext.broadcast(contents)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(held.value)
        for batch in batches:
            found = [compressors.verdict(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[2] < MARGIN for f in found], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"],
            )

    held_out = (crc_bucket("doc_id", FOLDS) == 0).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held_out, F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean"
    )


def identified(docs: DataFrame) -> DataFrame:
    """Dictionaries from the labelled rows of ``docs`` outside fold 0, and the prediction for all rows."""
    return predicted(docs, dictionaries(docs))
