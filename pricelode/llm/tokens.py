"""Encoding of texts with a public byte-level BPE vocabulary, by recursive DuckDB queries."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: the pattern by which byte-level BPE splits text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of distinct words that one recursive query takes, and words that a task remembers.
QUERY_BYTES = 150_000
REMEMBERED = 200_000

#: Rows are the tokens of words, by place; the key (word, place) keeps the last state of each, so that a word of n bytes holds n
#: rows however many steps it takes. A step finds the pair of least rank of each word that changed in the step before,
#: contracts its occurrences from the left (in a run of overlapping ones every other), and goes on until no pair of a word
#: has a rank. Contracting all occurrences at once gives what contracting the leftmost time after time does, as a merge makes
#: no pair of a lower rank.
ENCODE = """
WITH RECURSIVE t(w, p, k, live) USING KEY (w, p) AS (
  SELECT w, p, k, true FROM words
  UNION (
    WITH pairs AS (SELECT w, p, k, lead(k) OVER place AS following, row_number() OVER place AS i FROM recurring.t WHERE live AND w IN (SELECT w FROM t) WINDOW place AS (PARTITION BY w ORDER BY p)),
    ranked AS (SELECT pairs.*, m.rank, m.merged FROM pairs LEFT JOIN merges m ON m.a = pairs.k AND m.b = pairs.following),
    least AS (SELECT w, min(rank) AS low FROM ranked GROUP BY w),
    hits AS (SELECT r.w, r.i, r.merged, r.i - row_number() OVER (PARTITION BY r.w ORDER BY r.i) AS run FROM ranked r JOIN least USING (w) WHERE r.rank = least.low),
    chosen AS (SELECT w, i, merged FROM hits QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY i) % 2 = 1)
    SELECT r.w, r.p, coalesce(c.merged, r.k), c.w IS NOT NULL
    FROM ranked r LEFT JOIN chosen c ON c.w = r.w AND c.i = r.i LEFT JOIN chosen gone ON gone.w = r.w AND gone.i = r.i - 1
    WHERE c.w IS NOT NULL OR gone.w IS NOT NULL
  )
)
SELECT w, list(k ORDER BY p) AS ids FROM t WHERE live GROUP BY w ORDER BY w
"""

#: The bytes of each text, in hexadecimal, in order of its tokens.
DECODE = "SELECT t, string_agg(bytes, '' ORDER BY p) AS bytes FROM given_ids JOIN pieces USING (id) GROUP BY t ORDER BY t"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordEncoder:
    """Token ids of words; one DuckDB database in memory, with the merge table, for each task."""

    def __init__(self, path: str) -> None:
        import duckdb

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.of_byte = np.array([vocabulary[c] for c in byte_characters()], np.int32)
        self.base = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        self.base.register("given", pa.table({
            "a": pa.array([vocabulary[a] for a, _ in pairs], pa.int32()), "b": pa.array([vocabulary[b] for _, b in pairs], pa.int32()),
            "rank": pa.array(range(len(pairs)), pa.int32()), "merged": pa.array([vocabulary[a + b] for a, b in pairs], pa.int32()),
        }))
        self.base.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.base.unregister("given")

    def encode(self, words: list[str]) -> list[np.ndarray]:
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.array([len(b) for b in raw])
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1], dtype=np.int32) - np.repeat(ends - sizes, sizes).astype(np.int32)
        rows = pa.table({
            "w": pa.array(np.repeat(np.arange(len(raw), dtype=np.int32), sizes)), "p": pa.array(places),
            "k": pa.array(self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]),
        })
        self.base.register("words", rows)
        ids = self.base.sql(ENCODE).to_arrow_table().column("ids").combine_chunks()
        self.base.unregister("words")
        flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _encoded(texts: list[str | None], encoder: WordEncoder, known: dict[str, np.ndarray], split: regex.Pattern) -> list[list[np.ndarray]]:
    """The pieces of ids of each text; new words are encoded together, in queries of bounded size."""
    words = [split.findall(t) if t else [] for t in texts]
    new = {w for own in words for w in own}
    if len(known) + len(new) > REMEMBERED:
        known.clear()
    missing = [w for w in new if w not in known]
    missing.sort(key=len)
    at = 0
    while at < len(missing):
        size, end = 0, at
        while end < len(missing) and (end == at or size < QUERY_BYTES):
            size += 4 * len(missing[end])
            end += 1
        part = missing[at:end]
        known.update(zip(part, encoder.encode(part)))
        at = end
    return [[known[w] for w in own] for own in words]


def _encode_batches(path: str, only_count: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder: WordEncoder | None = None
    known: dict[str, np.ndarray] = {}
    split = regex.compile(PATTERN)
    for batch in batches:
        for start in range(0, batch.num_rows, 2_000):
            part = batch.slice(start, 2_000)
            encoder = encoder or WordEncoder(path)
            pieces = _encoded(part.column(1).to_pylist(), encoder, known, split)
            counts = np.array([sum(map(len, own)) for own in pieces], np.int64)
            if only_count:
                out = pa.array(counts)
            else:
                every = [x for own in pieces for x in own]
                flat = np.concatenate(every) if every else np.array([], np.int32)
                out = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), out], ["id", "out"])


class Decoder:
    """Texts of token ids, by ordered aggregation of the bytes of their tokens."""

    def __init__(self, path: str) -> None:
        import duckdb

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_characters())}
        spelled = {i: bytes(byte[c] for c in token).hex() for token, i in vocabulary.items() if all(c in byte for c in token)}
        self.base = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB", "temp_directory": ""})
        self.base.register("given", pa.table({"id": pa.array(spelled, pa.int32()), "bytes": pa.array(spelled.values(), pa.string())}))
        self.base.execute("CREATE TABLE pieces AS SELECT * FROM given")
        self.base.unregister("given")

    def decode(self, ids: pa.ListArray) -> list[str | None]:
        counts = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()], np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        self.base.register("given_ids", pa.table({
            "t": pa.array(np.repeat(np.arange(len(counts), dtype=np.int32), counts)), "p": pa.array(np.arange(total) - np.repeat(ends - counts, counts)), "id": pa.array(ids.flatten(), pa.int32()),
        }))
        found = self.base.sql(DECODE).to_arrow_table()
        self.base.unregister("given_ids")
        texts = dict(zip(found.column("t").to_pylist(), found.column("bytes").to_pylist()))
        return [None if missing else bytes.fromhex(texts.get(i, "")).decode("utf-8", "replace") for i, missing in enumerate(ids.is_null().to_pylist())]


def _decode_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decoder: Decoder | None = None
    for batch in batches:
        for start in range(0, batch.num_rows, 2_000):
            part = batch.slice(start, 2_000)
            decoder = decoder or Decoder(path)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(decoder.decode(part.column(1)), pa.string())], ["id", "text"])


def token_texts(frame: DataFrame, row: str, ids: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """The row id and text of each list of token ids: what token_ids made them from (the empty text for an empty list).

    A null list gives a null text; ids that are in no vocabulary and special tokens give nothing; bytes that are no UTF-8
    become the replacement character. One row per row.
    """
    kind = dict(frame.dtypes)[row]
    return frame.select(F.col(row).alias("id"), F.col(ids).cast("array<int>").alias("ids")).mapInArrow(partial(_decode_batches, tokenizer), f"id {kind}, text string").withColumnRenamed("id", row)


def spread(frame: DataFrame) -> DataFrame:
    """At least two tasks a core: few input splits would leave cores idle in a step that is all computation."""
    wanted = 2 * frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= wanted else frame.repartition(wanted)


def _run(frame: DataFrame, row: str, text: Column, path: str, only_count: bool) -> DataFrame:
    kind = dict(frame.dtypes)[row]
    given = frame.select(F.col(row).alias("id"), text.alias("text"))
    return spread(given).mapInArrow(partial(_encode_batches, path, only_count), f"id {kind}, out {'bigint' if only_count else 'array<int>'}")


def token_ids(frame: DataFrame, row: str, text: Column, tokenizer: str = TOKENIZER) -> DataFrame:
    """The row id and ids (ARRAY<INT>) of each text in a byte-level BPE vocabulary, without special tokens; one row per row.

    Empty and null texts both give an empty list. Text that looks like a special token is ordinary text. Whole texts are
    encoded, however long; repeated rows give repeated results; other columns are ignored; an empty table gives none.

    Each task splits its texts into words and encodes the distinct ones by a recursive query (ENCODE) over the merge table,
    in parts of bounded size; nothing but the texts is read, and nothing is shuffled unless the input has too few splits.
    `tokenizer` is the path of the vocabulary on every executor.
    """
    return _run(frame, row, text, tokenizer, False).select(F.col("id").alias(row), F.col("out").alias("ids"))


def token_counts(frame: DataFrame, row: str, text: Column, tokenizer: str = TOKENIZER) -> DataFrame:
    """The row id and n_tokens (BIGINT) of each text; as token_ids, but only the lengths leave the task."""
    return _run(frame, row, text, tokenizer, True).select(F.col("id").alias(row), F.col("out").alias("n_tokens"))
