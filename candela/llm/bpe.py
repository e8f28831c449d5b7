"""Distinct-word table: byte-pair encoding and decoding with a public tokenizer file.

Encoding. Tasks split whole texts at ASCII white space into words; a block keeps its documents as positions in
a table of its distinct words. The blocks' tables meet in hash buckets, where every distinct word of the corpus
is encoded once by the tokenizers library; the ids go back to the blocks and are joined by position. The
tokenizer drops white space and none of its patterns crosses it, so the ids of a text are those of its words
one after the other (special tokens inside a word are met by the library itself).

Decoding joins ids with the table id -> piece, whose size the vocabulary bounds (``MAX_PIECES``), and puts the
pieces together as a tokenizer without a decoder does: joined by one space. A tokenizer with a decoder is refused.

Defined cases. Null text: empty, no ids. Null document ids and repeated rows stay rows. Ids outside the
vocabulary and nulls among them decode to nothing, as the library skips them. Empty input: no rows. Further
columns are ignored. Memory follows the longest single text and a block's distinct words.
"""

from __future__ import annotations

import hashlib
import json
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import bucket_count, packer, pick, read_table, release, stored_by_block, table_bytes, texts_of

BLOCK_BYTES = 16 << 20
MAX_PIECES = 1 << 20
WORDS = "block long, n_distinct long, packed binary, words binary"
MESSAGE = "bucket int, block long, words binary"
ANSWER = "block long, bucket int, sizes binary, ids binary"


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text; it travels to the tasks, so executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _tokenizer(text: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces_of(tokenizer_text: str) -> list[str | None]:
    """Piece of each id."""
    spec = json.loads(tokenizer_text)
    if spec.get("decoder"):
        raise ValueError("only tokenizers without a decoder are supported")
    known = {i: p for p, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    if max(known, default=0) >= MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    return [known.get(i) for i in range(max(known, default=-1) + 1)]


def _zip(data: bytes, level: int = 3) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(data)


def _unzip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _word_table(packed: bytes, id_col: str, text_col: str) -> tuple[bytes, list[bytes]]:
    """The block with its texts as codes of words; its distinct words by hash."""
    import xxhash
    from collections import defaultdict

    table = read_table(packed)
    table_of: dict[bytes, int] = defaultdict(count().__next__)
    sizes, codes = [], []
    for text in texts_of(table.column(text_col)):
        words = text.split()
        sizes.append(len(words))
        codes.append(np.fromiter(map(table_of.__getitem__, words), np.uint32, len(words)))
    words = list(table_of)
    order = np.argsort(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    flat = rank[np.concatenate(codes)] if codes else np.empty(0, np.uint32)
    plane = flat.view(np.uint8).reshape(-1, 4).T  # bytes of equal weight side by side pack better
    head = table_bytes(pa.table({id_col: table.column(id_col), "_size": pa.array(sizes, pa.int64())}))
    record = len(head).to_bytes(8, "little") + head + _zip(np.ascontiguousarray(plane).tobytes())
    return record, [words[i] for i in order]


def _codes(record: bytes) -> tuple[pa.Table, np.ndarray]:
    n = int.from_bytes(record[:8], "little")
    table = read_table(record[8 : 8 + n])
    plane = np.frombuffer(_unzip(record[8 + n :]), np.uint8).reshape(4, -1)
    return table, np.ascontiguousarray(plane.T).view(np.uint32).ravel()


def _encoded(docs: DataFrame, tokenizer_text: str, id_col: str, text_col: str, block_bytes: int, rows, schema: str) -> DataFrame:
    """Apply ``rows(id column, iterator of each document's ids)`` to every block."""
    spark = docs.sparkSession
    docs = pick(docs, **{id_col: "long", text_col: "string"})
    gather = packer(text_col, block_bytes)

    def split(batches):
        for block in gather(batches):
            record, words = _word_table(block.column("packed")[0].as_py(), id_col, text_col)
            yield pa.RecordBatch.from_arrays(
                [block.column("block"), pa.array([len(words)], pa.int64()), pa.array([record], pa.binary()), pa.array([_zip(b"\n".join(words))], pa.binary())],
                names=["block", "n_distinct", "packed", "words"])
            release()

    blocks = stored_by_block(docs.mapInArrow(split, WORDS), "words")
    buckets = bucket_count(spark, blocks.agg(F.sum("n_distinct")).first()[0] or 0)
    shared = spark.sparkContext.broadcast(tokenizer_text)

    def send(batches):
        import xxhash

        edge = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                words = _unzip(packed).split(b"\n") if packed else []
                words = [] if words == [b""] else words
                cut = np.searchsorted(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), edge).tolist()
                cut = [0, *cut, len(words)]
                out = [(i, block, _zip(b"\n".join(words[a:b]))) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                                                     names=["bucket", "block", "words"])

    def encode_bucket(table: pa.Table) -> pa.Table:
        lists = [_unzip(x).split(b"\n") for x in table.column("words").to_pylist()]
        number = {w: i for i, w in enumerate(dict.fromkeys(w for words in lists for w in words))}
        tokenizer, words, ids = _tokenizer(shared.value), list(number), []
        for i in range(0, len(words), 10_000):
            got = tokenizer.encode_batch([w.decode() for w in words[i : i + 10_000]], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint32) for e in got]
        size = np.array([len(x) for x in ids], np.int64)
        flat, at = np.concatenate(ids), np.concatenate(([0], np.cumsum(size)))
        out_sizes, out_ids = [], []
        for own in lists:
            use = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
            out_sizes.append(_zip(size[use].astype(np.uint32).tobytes()))
            out_ids.append(_zip(_gathered(flat, at, size, use).tobytes()))
        bucket = table.column("bucket")[0].as_py()
        del lists, number, words, ids, got
        release()
        return pa.table({"block": table.column("block").cast(pa.int64()), "bucket": pa.array([bucket] * len(out_ids), pa.int32()),
                         "sizes": pa.array(out_sizes, pa.binary()), "ids": pa.array(out_ids, pa.binary())})

    def join_back(left: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("bucket").to_numpy())
        sizes, ids = answers.column("sizes").to_pylist(), answers.column("ids").to_pylist()
        size = np.concatenate([np.empty(0, np.uint32)] + [np.frombuffer(_unzip(sizes[i]), np.uint32) for i in order]).astype(np.int64)
        flat = np.concatenate([np.empty(0, np.uint32)] + [np.frombuffer(_unzip(ids[i]), np.uint32) for i in order])
        at = np.concatenate(([0], np.cumsum(size)))
        out = []
        for record in left.column("packed").to_pylist():
            table, codes = _codes(record)
            stop = np.cumsum(table.column("_size").to_numpy())

            def documents():
                for a, b in zip([0, *stop[:-1].tolist()], stop.tolist()):
                    yield _gathered(flat, at, size, codes[a:b])

            out.append(rows(table.column(id_col), documents()))
        release()
        return pa.concat_tables(out)

    answers = blocks.select("block", "words").mapInArrow(send, MESSAGE).groupBy("bucket").applyInArrow(encode_bucket, ANSWER)
    return blocks.select("block", "packed").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join_back, schema)


def _gathered(flat: np.ndarray, at: np.ndarray, size: np.ndarray, use: np.ndarray) -> np.ndarray:
    """The ids of the words ``use``, one after the other."""
    n = size[use]
    stop = np.cumsum(n)
    total = int(stop[-1]) if len(stop) else 0
    return flat[np.arange(total) + np.repeat(at[:-1][use] - (stop - n), n)]


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id and ``ids``."""

    def rows(ids, documents) -> pa.Table:
        return pa.table({id_col: ids, "ids": pa.array([x.astype(np.int32) for x in documents], pa.list_(pa.int32()))})

    return _encoded(docs, read_tokenizer(tokenizer_path), id_col, text_col, block_bytes, rows, f"{id_col} long, ids array<int>")


class PieceTable:
    """The table id -> piece, and the table id -> decimal text, as arrays that are joined by id."""

    def __init__(self, pieces: list[str | None]):
        self.known = np.array([p is not None for p in pieces] + [False])
        self.piece = np.array([(p or "").encode() for p in pieces] + [b""], object)
        self.number = np.array([str(i).encode() for i in range(len(pieces))] + [b""], object)

    def decoded(self, ids: np.ndarray) -> bytes:
        ids = np.where((ids >= 0) & (ids < len(self.known) - 1), ids, len(self.known) - 1)
        return b" ".join(self.piece[ids[self.known[ids]]].tolist())

    def numbers(self, ids: np.ndarray) -> bytes:
        return b" ".join(self.number[ids].tolist())


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and ``decoded`` (null ids: empty)."""
    pieces = encoded.sparkSession.sparkContext.broadcast(pieces_of(read_tokenizer(tokenizer_path)))

    def run(batches):
        table = PieceTable(pieces.value)
        for batch in batches:
            texts = [table.decoded(np.array([-1 if i is None else i for i in x or []], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=[id_col, "decoded"])

    return pick(encoded, **{id_col: "long", ids_col: "array<int>"}).mapInArrow(run, f"{id_col} long, decoded string")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Encode and decode every text: per row id, n_tokens, the SHA-256 of the ids (decimal, joined by one space) and of
    the decoded text, and the ids themselves if asked for."""
    text = read_tokenizer(tokenizer_path)
    pieces = docs.sparkSession.sparkContext.broadcast(pieces_of(text))

    def rows(ids, documents) -> pa.Table:
        table, out = PieceTable(pieces.value), []
        for x in documents:
            out.append((len(x), hashlib.sha256(table.numbers(x)).hexdigest(), hashlib.sha256(table.decoded(x)).hexdigest(), x.astype(np.int32) if with_ids else None))
        names, types = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"], [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
        columns = {n: pa.array([r[j] for r in out], t) for j, (n, t) in enumerate(zip(names, types)) if n != "ids" or with_ids}
        return pa.table({id_col: ids, **columns})

    return _encoded(docs, text, id_col, text_col, block_bytes, rows,
                    f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
