"""SimHash near-duplicates by segment-popcount embedding.

Fingerprint: each of 64 bits is 1 if set in more than half of the XXH64 hashes of the word shingles.
Embedding: the fingerprint's ``SEGMENTS`` segments become their bit counts. Changing one bit moves one count by
one, so the Manhattan distance of two count vectors is at most their Hamming distance.
Grid range-join: every distinct fingerprint is sent to the grid cells (count vectors) within ceil(max_bits / 2)
of its own. Two vectors within max_bits have such a cell in common: the middle of a shortest path. Inside a cell
pairs are filtered by Manhattan distance, then verified by their differing bits.
A cell with more than ``DENSE`` fingerprints is not paired: its members go, together with all other dense ones,
to the bit patterns within half the distance of themselves; members that meet at a pattern are within max_bits
of its inner ones, so a star per pattern loses no link. It is exact, and linear in the rows.
Components of the links are found by alternating stars.

Defined cases. Null or empty text, or one without words: fingerprint zero, linked like any other. Null ids take
part; a component's id is its smallest id that is not null (null if it has none). Repeated rows stay rows. Empty
input: no rows. Further columns are ignored (``near_duplicates``) or kept (``keep_one``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pick, replace_column, stored, texts_of
from candela.llm.components import components

SEED = 42
SEGMENTS = 16
DENSE = 1024
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int) -> int:
    """Fingerprint of one text (UTF-8)."""
    import xxhash

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        stop = np.cumsum(size)
        starts = (stop - size)[:n].tolist()
        ends = (stop - 1)[shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, n)
    total = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i : i + (1 << 14)]
        total += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(sum(1 << j for j in np.flatnonzero(2 * total > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """Per row: id and ``fp`` (the fingerprint's 64 bits as a long)."""

    def run(batches):
        for batch in batches:
            got = np.array([fingerprint(t, shingle) for t in texts_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], names=[id_col, "fp"])

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(run, f"{id_col} long, fp long")


def _counts(fp: np.ndarray, segments: int) -> np.ndarray:
    bits = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fp), segments, 64 // segments).sum(axis=2, dtype=np.int64)


def _balls(counts: np.ndarray, radius: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for all grid cells within ``radius`` of each row's counts."""
    base = np.int64(top + 1) ** np.arange(counts.shape[1], dtype=np.int64)
    row, at = np.arange(len(counts)), counts
    rows, cells = [row], [at @ base]
    for _ in range(radius):
        grown = []
        for j in range(counts.shape[1]):
            for step in (-1, 1):
                ok = (at[:, j] + step >= 0) & (at[:, j] + step <= top)
                new = at[ok].copy()
                new[:, j] += step
                grown.append((row[ok], new))
        row, at = np.concatenate([g[0] for g in grown]), np.concatenate([g[1] for g in grown])
        rows.append(row)
        cells.append(at @ base)
    pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(cells)]), axis=1) if radius > 1 else np.stack([np.concatenate(rows), np.concatenate(cells)])
    return pairs[0], pairs[1]


def _patterns(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bit pattern, distance) for all patterns within ``radius`` bits."""
    row, at = np.arange(len(fp)), fp
    rows, patterns, far = [row], [at], [np.zeros(len(fp), np.int64)]
    last = np.full(len(fp), -1)
    for r in range(radius):
        grown = [(row[last < j], at[last < j] ^ np.uint64(1 << j), j) for j in range(64)]
        row, at = np.concatenate([g[0] for g in grown]), np.concatenate([g[1] for g in grown])
        last = np.concatenate([np.full(len(g[0]), g[2]) for g in grown])
        rows.append(row)
        patterns.append(at)
        far.append(np.full(len(row), r + 1))
    return np.concatenate(rows), np.concatenate(patterns), np.concatenate(far)


def links(distinct: DataFrame, max_bits: int, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """``distinct`` (fp long, no repeats) -> edges (a long, b long) that connect all fingerprints within
    ``max_bits``; only true links are among them."""
    if 64 % segments or not 0 <= max_bits <= 8 or (64 // segments + 1) ** segments >= 1 << 63:
        raise ValueError("segments must divide 64 and give a 63-bit grid; max_bits 0 to 8")
    top, radius = 64 // segments, -(-max_bits // 2)

    def embed(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1 << 14):
                fp = batch.column(0).slice(i, 1 << 14).to_numpy()
                row, cell = _balls(_counts(fp.view(np.uint64), segments), radius, top)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp[row])], names=["cell", "fp"])

    def pair(cell: np.ndarray, fp: np.ndarray):
        """Edges among the rows of whole cells; rows of a cell lie together."""
        new = np.ones(len(cell), bool)
        new[1:] = cell[1:] != cell[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.concatenate((start, [len(cell)])))
        crowded = np.repeat(size > dense, size)
        keep = np.repeat((size > 1) & (size <= dense), size)
        c, f = cell[keep], fp[keep].view(np.uint64)
        a, b, far = [], [], 1
        live = np.arange(len(c))
        counts = _counts(f, segments).astype(np.int8) if len(f) else np.empty((0, segments), np.int8)
        while True:
            live = live[live + far < len(c)]
            live = live[c[live] == c[live + far]]
            if not len(live):
                break
            for i in range(0, len(live), 1 << 16):
                x = live[i : i + (1 << 16)]
                near = np.abs(counts[x] - counts[x + far]).sum(axis=1) <= max_bits
                x = x[near]
                x = x[np.bitwise_count(f[x] ^ f[x + far]) <= max_bits]
                a.append(f[x])
                b.append(f[x + far])
            far += 1
        edges = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1) if a else np.empty((2, 0), np.uint64)
        return edges.view(np.int64), np.unique(fp[crowded])

    def verify(batches):
        held_cell, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        crowd = None  # cell known to be crowded: its further rows pass at once

        def out(edges, alone):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate((edges[0], alone))), pa.array(np.concatenate((edges[1], np.zeros(len(alone), np.int64)))),
                                               pa.array(np.repeat([False, True], [edges.shape[1], len(alone)]))], names=["a", "b", "dense"])

        none = np.empty((2, 0), np.int64)
        for batch in batches:
            cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if crowd is not None:
                same = cell == crowd
                if same.any():
                    yield out(none, fp[same])
                cell, fp = cell[~same], fp[~same]
                if not len(cell):
                    continue
                crowd = None
            cell, fp = np.concatenate((held_cell, cell)), np.concatenate((held_fp, fp))
            cut = int(np.searchsorted(cell, cell[-1]))
            if cut:
                yield out(*pair(cell[:cut], fp[:cut]))
            held_cell, held_fp = cell[cut:], fp[cut:]
            if len(held_cell) > dense:
                yield out(none, held_fp)
                crowd, held_cell, held_fp = held_cell[0], held_cell[:0], held_fp[:0]
        if len(held_cell):
            yield out(*pair(held_cell, held_fp))

    cells = distinct.select("fp").mapInArrow(embed, "cell long, fp long").repartition("cell").sortWithinPartitions("cell")
    found = stored(cells.mapInArrow(verify, "a long, b long, dense boolean"), "links")
    edges = found.where("not dense").select("a", "b")
    crowded = found.where("dense").select(F.col("a").alias("fp")).distinct()
    if crowded.isEmpty():
        return edges
    inner = max_bits // 2

    def spread(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(i, 4096).to_numpy()
                row, pattern, far = _patterns(fp.view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(pattern.view(np.int64)), pa.array(fp[row]), pa.array(far <= inner)], names=["pattern", "fp", "inner"])

    at = stored(crowded.mapInArrow(spread, "pattern long, fp long, inner boolean"), "patterns")
    centre = at.groupBy("pattern").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("c")).where("c is not null")
    stars = at.join(centre, "pattern").where("fp <> c").select(F.col("c").alias("a"), F.col("fp").alias("b"))
    return edges.unionByName(stars.distinct())


def _grouped(rows: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``rows`` (id, fp)."""
    distinct = stored(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    roots = components(links(distinct, max_bits))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    return rows.join(_grouped(rows, id_col, max_bits), "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with all columns, one row of each component: that with the smallest id (null ids last); of several
    rows with that id the one with the smallest hash of all columns; of wholly equal rows one."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    i, t = f"c{replace_column(docs.columns, id_col)}", f"c{replace_column(docs.columns, text_col)}"
    plain = docs.toDF(*names).withColumn("_row", F.xxhash64(*names))

    def run(batches):
        for batch in batches:
            got = np.array([fingerprint(x, shingle) for x in texts_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(got.view(np.int64))], names=["id", "_row", "fp"])

    rows = plain.select(F.col(i).cast("long").alias("id"), F.col(t).cast("string").alias("text"), "_row")
    rows = stored(rows.mapInArrow(run, "id long, _row long, fp long"), "simhash")
    equal = rows.join(_grouped(rows, "id", max_bits), "fp").groupBy("root", "id", "_row").agg(F.count(F.lit(1)).alias("n"))
    first = equal.groupBy("root").agg(F.min(F.struct(F.isnull("id").alias("no_id"), "id", "_row", "n")).alias("k"))
    first = stored(first.select(F.col("k.id").alias("_id"), F.col("k._row").alias("_hash"), F.col("k.n").alias("n")), "kept")
    is_it = F.col(i).cast("long").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    single = plain.join(first.where("n = 1"), is_it, "left_semi").select(*names)
    several = plain.join(first.where("n > 1"), is_it, "left_semi").dropDuplicates([i, "_row"]).select(*names)
    return single.unionByName(several).toDF(*docs.columns)
