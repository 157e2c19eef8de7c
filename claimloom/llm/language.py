"""Language identification by compression.

For each language, a raw-content zstandard dictionary is filled with sample
text of that language. A text is compressed, piece by piece, once per
dictionary; the language that compresses it best is the answer. Pieces make
the dictionary count throughout a long text. The score is 1/2 for two equal
sizes and grows to 1 with the margin between the best and the second best.

Rejected (``rejected``): texts that are null or have no letter (``lang_pred``
is ``und``, score 0), and texts of ``JUDGED_BYTES`` folded bytes or more whose
margin is below ``min_margin``: they resemble no learned language. Equal sizes go to the language with more
sample rows, then to the first by name. Rows without language or text teach
nothing; without any language every row is ``und``. Each row of ``docs`` gives
one row, repeated ids and null ids included; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimloom.llm.batches import pieces

UNKNOWN = "und"
DICTIONARY_BYTES = 110_000  # sample text per language
SAMPLE_DOCS = 400  # documents drawn per language, about
SAMPLE_CHARS = 2_000  # of each drawn document: variety matters more than length
PIECE = 8_192
LEVEL = 7
# Sizes this close, relative to the second best, tell no language; but a text of
# fewer folded bytes is too short to be rejected for it.
MIN_MARGIN = 0.035
JUDGED_BYTES = 100
# Letters stay, A-Z lower-cased (other letters before); other ASCII becomes a space.
_FOLD = bytes(
    c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def folded(text: str) -> bytes:
    """Lower-cased words of a text, separated by single spaces, in UTF-8."""
    return b" ".join(text.lower().encode().translate(_FOLD).split())


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def language_samples(
    docs: DataFrame,
    lang: str,
    text: str,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> dict[str, tuple[int, bytes]]:
    """Per language its number of rows and its dictionary content.

    Documents are drawn by a hash of their text. Copies are drawn together, so
    the share follows from the count of distinct texts (known to a few
    hundredths, hence the half more): ``sample_docs`` distinct texts per language
    or more, if there are so many, and at most twice as many reach the driver.
    """
    known = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0))
    sizes = known.groupBy(lang).agg(F.count("*"), F.approx_count_distinct(F.xxhash64(text))).collect()
    counts, distinct = {r[0]: r[1] for r in sizes}, {r[0]: max(1, r[2]) for r in sizes}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in distinct.items() for x in (k, min(1.0, 1.5 * sample_docs / n))])
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = (
        known.where(place < share[F.col(lang)])
        .select(F.col(lang).alias("lang"), F.substring(text, 1, sample_chars).alias("piece"))
        .distinct()  # copies of one text say nothing new
        .withColumn("at", F.row_number().over(_by_hash()))
        .where(F.col("at") <= 2 * sample_docs)
        .orderBy("lang", "at")
    )
    content: dict[str, bytearray] = {k: bytearray() for k in counts}
    for row in drawn.collect():
        if len(content[row.lang]) < DICTIONARY_BYTES:
            content[row.lang] += folded(row.piece) + b" "
    return {k: (counts[k], bytes(v[:DICTIONARY_BYTES])) for k, v in sorted(content.items())}


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy(F.xxhash64("piece"), "piece")


class Classifier:
    """Compressors that hold one dictionary each."""

    def __init__(self, samples: Mapping[str, tuple[int, bytes]], level: int = LEVEL, piece: int = PIECE):
        import zstandard as zstd

        self.piece = piece
        self.compressors = {}
        for lang, (_, content) in sorted(samples.items(), key=lambda s: (-s[1][0], s[0])):
            settings = zstd.ZstdCompressionParameters.from_level(
                level, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            held = zstd.ZstdCompressionDict(content or b" " * 8, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            self.compressors[lang] = zstd.ZstdCompressor(dict_data=held, compression_params=settings)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; the margin is relative to the second best size."""
        return self.judge(text, 0.0)[:3]

    def judge(self, text: str | None, min_margin: float = MIN_MARGIN) -> tuple[str, float, float, bool]:
        """Language, score, margin, and whether the text is rejected: no letter, or long enough for so narrow a margin."""
        if not self.compressors or not text or not has_letter(text):
            return UNKNOWN, 0.0, 0.0, True
        data = folded(text)
        pieces = [data[i : i + self.piece] for i in range(0, len(data), self.piece)]
        sizes = {
            lang: sum(len(compressor.compress(p)) for p in pieces)
            for lang, compressor in self.compressors.items()
        }
        best = min(sizes, key=sizes.get)
        second = min((s for lang, s in sizes.items() if lang != best), default=None)
        margin = 1.0 if not second else (second - sizes[best]) / second
        return best, 0.5 + margin / 2, margin, margin < min_margin and len(data) >= JUDGED_BYTES


def identify(
    docs: DataFrame,
    samples: Mapping[str, tuple[int, bytes]],
    text: str,
    keep: Mapping[str, Column],
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """(columns of ``keep``, lang_pred, score, margin, rejected) per row of ``docs``."""

    def predict(batches):
        classifier = Classifier(samples)
        for piece in pieces(batches):
            found = [classifier.judge(t, min_margin) for t in piece.column(0).to_pylist()]
            lang, score, margin, rejected = (list(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[1:], *map(pa.array, (lang, score, margin, rejected))],
                names=[*piece.schema.names[1:], "lang_pred", "score", "margin", "rejected"],
            )

    rows = docs.select(F.col(text).alias("_text"), *[c.alias(name) for name, c in keep.items()])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(predict, f"{fields}, lang_pred string, score double, margin double, rejected boolean")


def drop_rejected(
    docs: DataFrame, samples: Mapping[str, tuple[int, bytes]], text: str, min_margin: float = MIN_MARGIN
) -> DataFrame:
    """The rows of ``docs`` whose language is told, all columns kept; every column crosses to Python once."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)

    def told(batches):
        classifier = Classifier(samples)
        for piece in pieces(batches):
            found = [classifier.judge(t, min_margin) for t in piece.column(at).to_pylist()]
            yield piece.filter(pa.array([not rejected for *_, rejected in found], pa.bool_()))

    rows = docs.toDF(*names)
    return rows.mapInArrow(told, rows.schema).toDF(*docs.columns)
