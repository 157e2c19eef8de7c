"""BPE encoding and decoding through a table of distinct words.

1. ``word_chunks`` splits texts into words. A chunk is a run of documents with
   about ``chunk_chars`` characters: its distinct words once, dealt into slots
   by hash and sorted, and each document's words as places in that order.
2. ``encode_words`` brings the slots of all chunks together. Equal words share a
   slot, so every distinct word of the corpus is encoded once.
3. ``encode_documents`` joins the ids back to their chunk by place, puts each
   document's words in order, and decodes through a join of the ids with the
   vocabulary's pieces (map-side: the vocabulary is as large as the tokenizer,
   whatever the data).

Texts are never shuffled, and places lie in buckets by chunk, so that only
distinct words move, packed: there once and their ids back once.

Null texts count as empty and have no tokens; special-token strings in a text
give their ids, as the library does by default; repeated rows and null
document ids are carried through; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from claimloom.staging import stage_buckets

CHUNK_CHARS = 8_000_000
MAX_WORDS = 2_000_000  # distinct words a task keeps
_ROWS = 256  # texts turned into Python strings at a time
_WORDS = 4096  # words given to the tokenizer at a time


def _latin(categories: str) -> str:
    """Characters below U+0180 of the given major categories, for a regex class."""
    return "".join(c for c in map(chr, range(0x180)) if unicodedata.category(c)[0] in categories)


def word_splitter(tokenizer_json: str) -> Callable[[str], list[str]]:
    """A text's words, exactly as the tokenizer's normaliser and splitter make them.

    Texts of plain Latin letters take a short cut: there lower-casing is per
    character, and normal form C and white space need no tables. All others go
    through the tokenizer's own steps.
    """
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    spec = json.loads(tokenizer_json)
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    pattern = split["pattern"]["Regex"]
    normalizer = Tokenizer.from_str(tokenizer_json).normalizer
    library = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=split["invert"])
    letters, numbers = _latin("L"), _latin("N")
    plain = re.compile(
        pattern.replace(r"\p{L}", re.escape(letters)).replace(r"\p{N}", re.escape(numbers))
    )
    unusual = re.compile("[^\t\n\r -~¡-¬®-ſ]")
    specials = [t["content"] for t in spec["added_tokens"]]
    special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None

    def words(text: str) -> list[str]:
        if not unusual.search(text):
            return plain.findall(text.lower())
        return [w for w, _ in library.pre_tokenize_str(normalizer.normalize_str(text))]

    def split_text(text: str) -> list[str]:
        if special is None or not any(s in text for s in specials):
            return words(text)
        parts = special.split(text)  # every second part is a special token
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words(part))]

    return split_text


def word_encoder(tokenizer_json: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of single words: the tokenizer without normaliser and splitter."""
    from tokenizers import Tokenizer, pre_tokenizers

    spec = json.loads(tokenizer_json) | {"normalizer": None, "truncation": None, "padding": None}
    tokenizer = Tokenizer.from_str(json.dumps(spec))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return lambda words: [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(start, _ROWS)
            yield from zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())


def word_chunks(
    docs: DataFrame, id: str, text: str, tokenizer_json: str, slots: int, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """(chunk, doc_ids, lengths, places, words), one row per chunk.

    A longer text is a chunk of its own. ``words`` has one packed list per slot
    (a word holds no white space, so line ends part them); ``places`` counts
    through all of them, document after document. Chunk numbers are unique in
    one run of the job, so the result has to be staged before it is used twice.
    """
    schema = "chunk bigint, doc_ids array<bigint>, lengths array<int>, places binary, words array<binary>"

    def split(batches):
        names = ["chunk", "doc_ids", "lengths", "places", "words"]
        words_of, compress = word_splitter(tokenizer_json), zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 32
        ids, lengths, runs, table, chars = [], [], [], {}, 0

        def chunk():
            dealt = [[] for _ in range(slots)]
            for word in table:
                dealt[zlib.crc32(word.encode()) % slots].append(word)
            order = np.empty(len(table), np.int32)
            at = 0
            for words in dealt:
                words.sort()
                order[[table[w] for w in words]] = np.arange(at, at + len(words))
                at += len(words)
            places = compress(order[np.concatenate(runs)].astype("<i4").tobytes())
            packed = [compress("\n".join(words).encode()) for words in dealt]
            arrays = [[number], [ids], [lengths], [places], [packed]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types)], names=names)

        for doc, value in _texts(batches):
            words = words_of(value or "")
            for word in words:
                if word not in table:
                    table[word] = len(table)
            ids.append(doc)
            lengths.append(len(words))
            runs.append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))
            chars += len(value or "")
            if chars >= chunk_chars:
                yield chunk()
                number += 1
                ids, lengths, runs, table, chars = [], [], [], {}, 0
        if ids:
            yield chunk()

    return docs.select(F.col(id).cast("long"), F.col(text)).mapInArrow(split, schema)


def encode_words(dealt: DataFrame, tokenizer_json: str) -> DataFrame:
    """(chunk, slot, counts, ids) of ``dealt(chunk, slot, words)``: packed, in the order of the words.

    The table of a task's distinct words is kept while its slots pass by; it
    starts anew beyond ``MAX_WORDS``.
    """

    def encode(batches):
        encoder, compress = word_encoder(tokenizer_json), zstandard.ZstdCompressor(level=3).compress
        table: dict[str, list[int]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                words = zstandard.decompress(row["words"]).decode().split("\n")
                if words == [""]:
                    continue
                if len(table) > MAX_WORDS:
                    table.clear()
                new = [w for w in words if w not in table]
                for start in range(0, len(new), _WORDS):
                    part = new[start : start + _WORDS]
                    table.update(zip(part, encoder(part)))
                coded = [table[w] for w in words]
                counts = np.array([len(x) for x in coded], "<u4")
                ids = np.fromiter(chain.from_iterable(coded), "<u4", int(counts.sum()))
                arrays = [[row["chunk"]], [row["slot"]], [compress(_planes(counts))], [compress(_planes(ids))]]
                types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, t) for a, t in zip(arrays, types)], names=["chunk", "slot", "counts", "ids"]
                )

    schema = "chunk bigint, slot int, counts binary, ids binary"
    return dealt.repartition("slot").select("chunk", "slot", "words").mapInArrow(encode, schema)


def _planes(numbers: np.ndarray) -> bytes:
    """All low bytes, then all next bytes, and so on: packs better."""
    return numbers.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> list[int]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().tolist()


def vocabulary(tokenizer_json: str) -> list[str]:
    """The piece of every id."""
    spec = json.loads(tokenizer_json)
    known = {i: piece for piece, i in spec["model"]["vocab"].items()}
    known |= {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [known.get(i, "") for i in range(max(known) + 1)]


def encode_documents(
    docs: DataFrame,
    id: str,
    text: str,
    tokenizer_json: str,
    finish: Callable[[str, str], tuple],
    schema: str,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """(doc_id, n_tokens, ...) per row of ``docs``.

    ``finish(ids, decoded)`` gets a document's ids, joined by one space, and
    its decoded text, and makes the columns named in ``schema``: both strings
    themselves (see ``encode``), or digests of them.
    """
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = stage_buckets(word_chunks(docs, id, text, tokenizer_json, slots, chunk_chars), "bpe_chunks", "chunk")
    coded = encode_words(chunks.select("chunk", F.posexplode("words").alias("slot", "words")), tokenizer_json)
    entry = F.struct("slot", "counts", "ids")
    tables = coded.groupBy("chunk").agg(F.array_sort(F.collect_list(entry)).alias("table"))
    whole = chunks.drop("words").join(tables, "chunk", "left").select(
        "doc_ids", "lengths", "places", F.col("table.counts").alias("counts"), F.col("table.ids").alias("ids")
    )
    pieces = vocabulary(tokenizer_json)

    def assemble(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, lengths, places, counts, coded = (batch.column(i)[row].as_py() for i in range(5))
                places = np.frombuffer(zstandard.decompress(places), "<i4")
                ids, spelled, sizes = [], [], []
                for packed_counts, packed_ids in zip(counts or [], coded or []):
                    flat, at = _unpacked(packed_ids), 0
                    for n in _unpacked(packed_counts):
                        own = flat[at : at + n]
                        at += n
                        sizes.append(n)
                        ids.append(" ".join(map(str, own)))
                        spelled.append(" ".join(map(pieces.__getitem__, own)))
                sizes = np.array(sizes or [0])
                end, out = 0, []
                for doc, length in zip(doc_ids, lengths):
                    own = places[end : end + length]
                    end += length
                    order = own.tolist()
                    decoded = " ".join(map(spelled.__getitem__, order))
                    out.append((doc, int(sizes[own].sum()), *finish(" ".join(map(ids.__getitem__, order)), decoded)))
                    if len(out) == _ROWS:
                        yield _rows(out, fields)
                        out = []
                if out:
                    yield _rows(out, fields)

    full = f"doc_id bigint, n_tokens bigint, {schema}"
    fields = [f.strip().split()[:2] for f in full.split(",")]
    return whole.mapInArrow(assemble, full)


_TYPES = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _rows(rows: list[tuple], fields: list[list[str]]) -> pa.RecordBatch:
    columns = [pa.array(values, _TYPES[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def encode(docs: DataFrame, id: str, text: str, tokenizer_json: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the token ids and the text they decode to."""

    def finish(ids: str, decoded: str) -> tuple:
        return list(map(int, ids.split())), decoded

    return encode_documents(docs, id, text, tokenizer_json, finish, "ids array<int>, decoded string")
