"""Repeated-phrase automata: remove passages that an earlier document already holds.

1. *Anchors.* Every window of ``window`` words picks the ``anchor``-word sequence of smallest hash inside it.
   Equal windows pick equal anchors, so only windows whose anchor occurs in two documents can recur. A block
   sends its distinct anchors; one bit each comes back.
2. *Confirm.* Windows over a recurring anchor are hashed whole (96 bits) and sent with the block's smallest
   document id that holds them; the smallest id of the whole corpus comes back.
3. *Automata.* A run of windows with the same smallest id forms a passage. Each block compiles the passages
   that concern it into Aho-Corasick automata (sharded so that none exceeds ``shard_words`` words; letters are
   word codes, so matches start and end on words) and streams all its documents through them. An occurrence
   of a passage in a document with a larger id than the passage's is removed.

Defined cases. Null text: no words. Null id: smaller than no id and larger than none, so nothing is removed
from such a row nor because of it. Rows that share an id never remove one another's words. Repeated rows stay
rows. Texts shorter than a window keep all words. Empty input: no rows. Further columns are ignored
(``substring_dedup``) or kept (``remove_repeats``). One block holds one text at least, so memory follows the
longest single text.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import BLOCK_BYTES, bucket_count, pack, pick, read_table, release, replace_column, stored, stored_by_block, texts_of
from candela.llm.spans import Spans, covered, sequence_hashes

MESSAGE = "bucket int, block long, keys binary, docs binary"
ANSWER = "block long, bucket int, answer binary"
WORDS_PER_SHARD = 200_000
ALPHABET = 64


class _Block:
    """Windows and anchors of one packed block."""

    def __init__(self, packed: bytes, id_col: str, text_col: str, window: int, anchor: int):
        self.table = read_table(packed)
        self.window = window
        ids = self.table.column(id_col)
        self.known = np.array([v.is_valid for v in ids], bool)
        self.ids = np.array(ids.fill_null(0), np.int64)
        self.spans = Spans(texts_of(self.table.column(text_col)))
        self.hash = self.spans.hashes(0)
        text = self.spans.text_of_word()
        n = max(0, len(text) - window + 1)
        at = np.flatnonzero((text[:n] == text[window - 1 :]) & self.known[text[:n]]) if n else np.empty(0, np.int64)
        self.at, self.text = at, text[at] if n else at
        if len(at):
            grams = sequence_hashes(self.hash, anchor)
            lowest = grams[:n].copy()
            for j in range(1, window - anchor + 1):
                np.minimum(lowest, grams[j : j + n], out=lowest)
            self.anchor = lowest[at]
        else:
            self.anchor = np.empty(0, np.uint64)

    @cached_property
    def anchors(self):
        """Distinct anchors, sorted; whether two documents of the block hold each; where each window's is."""
        keys, back = np.unique(self.anchor, return_inverse=True)
        doc = self.ids[self.text]
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, back, doc)
        np.maximum.at(high, back, doc)
        return keys, low != high, back

    def windows(self, recurring: np.ndarray):
        """Windows over recurring anchors: positions, distinct hashes (sorted), smallest id of each, inverse."""
        _, _, back = self.anchors
        use = np.flatnonzero(recurring[back]) if len(back) else np.empty(0, np.int64)
        at = self.at[use]
        h = np.empty(len(at), [("a", "<u8"), ("b", "<u4")])
        if len(at):
            h["a"] = sequence_hashes(self.hash, self.window)[at]
            h["b"] = (sequence_hashes(self.spans.hashes(1), self.window)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((h["b"], h["a"]))
        s = h[order]
        new = np.ones(len(s), bool)
        new[1:] = (s["a"][1:] != s["a"][:-1]) | (s["b"][1:] != s["b"][:-1])
        back = np.empty(len(s), np.int64)
        back[order] = np.cumsum(new) - 1
        low = np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(low, back, self.ids[self.text[use]])
        return at, self.text[use], s[new], low, back


def _cuts(a: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's share of the sorted keys begins (buckets are ranges of the hash)."""
    edge = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(a, edge), [len(a)])).astype(np.int64)


def _zip(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


WINDOW_KEY = [("a", "<u8"), ("b", "<u4")]


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)],
                                      names=[n for n, _ in schema])


_MESSAGE = [("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary())]
_ANSWER = [("block", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())]


def _settled_anchors(table: pa.Table) -> pa.Table:
    """Per anchor of a bucket: do two documents hold it? One bit for each anchor of each block, in its order."""
    blocks = table.column("block").to_pylist()
    keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    many = [_unzip(x, np.bool_) for x in table.column("docs").to_pylist()]
    everything = np.concatenate(keys)
    _, back, count = np.unique(everything, return_inverse=True, return_counts=True)
    shared = count > 1
    shared[back[np.concatenate(many)]] = True
    parts = np.split(shared[back], np.cumsum([len(k) for k in keys])[:-1])
    bucket = table.column("bucket")[0].as_py()
    return pa.Table.from_batches([_batch(_ANSWER, [(b, bucket, _zip(np.packbits(p))) for b, p in zip(blocks, parts)])])


def _settled_windows(table: pa.Table) -> pa.Table:
    """Smallest document id of each window of a bucket, less the block's own smallest (zero: it is the first)."""
    blocks = table.column("block").to_pylist()
    keys = [_unzip(x, WINDOW_KEY) for x in table.column("keys").to_pylist()]
    lows = [_unzip(x, np.int64) for x in table.column("docs").to_pylist()]
    k, low = np.concatenate(keys), np.concatenate(lows)
    order = np.lexsort((k["b"], k["a"]))
    s = k[order]
    new = np.ones(len(s), bool)
    new[1:] = (s["a"][1:] != s["a"][:-1]) | (s["b"][1:] != s["b"][:-1])
    least = np.minimum.reduceat(low[order], np.flatnonzero(new))
    first = np.empty(len(s), np.int64)
    first[order] = least[np.cumsum(new) - 1]
    parts = np.split(first - low, np.cumsum([len(x) for x in keys])[:-1])
    bucket = table.column("bucket")[0].as_py()
    return pa.Table.from_batches([_batch(_ANSWER, [(b, bucket, _zip(p)) for b, p in zip(blocks, parts)])])


def _in_order(answers: pa.Table, kind, sizes: np.ndarray | None = None) -> np.ndarray:
    got = {b: a for b, a in zip(answers.column("bucket").to_pylist(), answers.column("answer").to_pylist())}
    parts = [_unzip(got[b], kind) for b in sorted(got)]
    if sizes is not None:
        parts = [np.unpackbits(p, count=int(sizes[b])).astype(bool) for p, b in zip(parts, sorted(got))]
    return np.concatenate(parts) if parts else np.empty(0, bool if sizes is not None else kind)


def _letters(codes: np.ndarray, width: int) -> np.ndarray:
    """Each code as ``width`` characters; every place has characters of its own, so matches are aligned."""
    out = np.empty((len(codes), width), np.uint32)
    for j in range(width):
        out[:, width - 1 - j] = codes % ALPHABET + 0x100 + (width - 1 - j) * ALPHABET
        codes = codes // ALPHABET
    return out


def _removed(block: _Block, at, text, first, shard_words: int) -> np.ndarray:
    """Which words of the block go. ``first``: smallest id that holds the window starting at each ``at``."""
    import ahocorasick

    spans, n = block.spans, len(block.spans)
    gone = np.zeros(n, bool)
    late = first < block.ids[text]
    at, text, first = at[late], text[late], first[late]
    if not len(at):
        return gone
    breaks = np.ones(len(at), bool)
    breaks[1:] = (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1]) | (first[1:] != first[:-1])
    head = np.flatnonzero(breaks)
    tail = np.concatenate((head[1:], [len(at)])) - 1
    starts, ends, origin = at[head], at[tail] + block.window, first[head]
    _, codes = np.unique(block.hash, return_inverse=True)
    width = 1
    while ALPHABET**width <= codes.max():
        width += 1
    page = _letters(codes, width)
    shard_of = np.cumsum(ends - starts) // shard_words
    for shard in np.unique(shard_of):
        automaton = ahocorasick.Automaton()
        for i in np.flatnonzero(shard_of == shard):
            phrase = page[starts[i] : ends[i]].tobytes().decode("utf-32-le")
            known = automaton.get(phrase, None)
            if known is None or origin[i] < known[1]:
                automaton.add_word(phrase, (int(ends[i] - starts[i]), int(origin[i])))
        automaton.make_automaton()
        found_start, found_end = [], []
        for t in range(len(block.ids)):
            a, b = spans.first[t], spans.first[t + 1]
            if not block.known[t] or b - a < block.window:
                continue
            own = int(block.ids[t])
            for end, (size, origin_id) in automaton.iter(page[a:b].tobytes().decode("utf-32-le")):
                if origin_id < own:
                    stop = a + (end + 1) // width
                    found_start.append(stop - size)
                    found_end.append(stop)
        gone |= covered(n, np.array(found_start, np.int64), np.array(found_end, np.int64))
    return gone


def _kept(docs: DataFrame, id_col: str, text_col: str, window: int, anchor: int, shard_words: int, block_bytes: int, rows, schema) -> DataFrame:
    if not 1 <= anchor <= window:
        raise ValueError("anchor must lie between 1 and window")
    blocks = stored_by_block(pack(docs, text_col, block_bytes), "repeats")
    spark = docs.sparkSession
    size = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = bucket_count(spark, size // 24)  # anchors: about every fourth word of six bytes

    def send_anchors(batches):
        for batch in batches:
            for b, packed in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist()):
                keys, many, _ = _Block(packed, id_col, text_col, window, anchor).anchors
                cut = _cuts(keys, buckets)
                rows_ = [(i, b, keys[x:y].tobytes(), _zip(many[x:y])) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
                if rows_:
                    yield _batch(_MESSAGE, rows_)
                release()

    def recurring(block: _Block, answers: pa.Table):
        keys, _, _ = block.anchors
        return _in_order(answers, np.uint8, np.diff(_cuts(keys, buckets)))

    def send_windows(left: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for b, packed in zip(left.column("block").to_pylist(), left.column("packed").to_pylist()):
            block = _Block(packed, id_col, text_col, window, anchor)
            _, _, keys, low, _ = block.windows(recurring(block, answers))
            cut = _cuts(keys["a"], buckets)
            out += [(i, b, _zip(keys[x:y]), _zip(low[x:y])) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
            del block, keys, low
        release()
        return pa.Table.from_batches([_batch(_MESSAGE, out)])

    def finish(left: pa.Table, answers: pa.Table) -> pa.Table:
        out, block = [], None
        for packed in left.column("packed").to_pylist():
            block = _Block(packed, id_col, text_col, window, anchor)
            step = answers.column("step").to_numpy()
            bits = answers.filter(pa.array(step == 0))
            back = answers.filter(pa.array(step == 1))
            at, text, _, low, inverse = block.windows(recurring(block, bits))
            first = (low + _in_order(back, np.int64))[inverse] if len(at) else low
            out.append(rows(block, _removed(block, at, text, first, shard_words)))
        del block
        release()
        return pa.concat_tables(out)

    def settle(messages: DataFrame, how) -> DataFrame:
        return messages.groupBy("bucket").applyInArrow(how, ANSWER)

    bits = settle(blocks.select("block", "packed").mapInArrow(send_anchors, MESSAGE), _settled_anchors)
    bits = stored(bits, "anchors")
    left = blocks.select("block", "packed").groupBy("block")
    back = settle(left.cogroup(bits.groupBy("block")).applyInArrow(send_windows, MESSAGE), _settled_windows)
    both = bits.withColumn("step", F.lit(0)).unionByName(back.withColumn("step", F.lit(1)))
    return left.cogroup(both.groupBy("block")).applyInArrow(finish, schema)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, anchor: int = 7,
                    shard_words: int = WORDS_PER_SHARD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_text (kept words joined by one space) and its SHA-256."""

    def rows(block: _Block, gone: np.ndarray) -> pa.Table:
        sp, out = block.spans, []
        for t in range(len(block.ids)):
            a, b = sp.first[t], sp.first[t + 1]
            kept = np.flatnonzero(~gone[a:b]) + a
            out.append((b - a, b - a - len(kept), b" ".join([sp.raw[x:y] for x, y in zip(sp.starts[kept].tolist(), sp.ends[kept].tolist())])))
        return pa.table({
            id_col: block.table.column(id_col), "n_words": pa.array([int(x[0]) for x in out], pa.int64()),
            "n_removed": pa.array([int(x[1]) for x in out], pa.int64()),
            "kept_text": pa.array([x[2] for x in out], pa.binary()).cast(pa.string()),
            "kept_sha256": pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string())})

    return _kept(pick(docs, **{id_col: "long", text_col: "string"}), id_col, text_col, window, anchor, shard_words, block_bytes, rows,
                 f"{id_col} long, n_words long, n_removed long, kept_text string, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, anchor: int = 7,
                   shard_words: int = WORDS_PER_SHARD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with all its columns; a text that loses words becomes its kept words joined by one space, all
    other texts stay as they are (null stays null)."""
    place, text_place = replace_column(docs.columns, id_col), replace_column(docs.columns, text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    plain = plain.withColumn(f"c{place}", F.col(f"c{place}").cast("long"))

    def rows(block: _Block, gone: np.ndarray) -> pa.Table:
        sp, texts = block.spans, block.table.column(f"c{text_place}").to_pylist()
        for t in range(len(texts)):
            a, b = sp.first[t], sp.first[t + 1]
            if gone[a:b].any():
                kept = np.flatnonzero(~gone[a:b]) + a
                texts[t] = b" ".join([sp.raw[x:y] for x, y in zip(sp.starts[kept].tolist(), sp.ends[kept].tolist())]).decode()
        return block.table.set_column(text_place, f"c{text_place}", pa.array(texts, pa.string()))

    schema = plain.schema
    out = _kept(plain, f"c{place}", f"c{text_place}", window, anchor, shard_words, block_bytes, rows, schema)
    return out.toDF(*docs.columns)
