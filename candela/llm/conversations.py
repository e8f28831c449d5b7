"""Conversation structure repair by parallel Viterbi with rank convergence.

A conversation's rows, in order of turn, are edited at least cost so that the role initials read ``(s?(ua)+)?``: Keep
0, Rerole to user or assistant 3, Delete 4 (a blank or duplicate row must go), Insert an empty user or assistant row 3; a
truncated row that stays adds 3. ``audit`` holds the initials of the edits, the ASCII-least among the cheapest.

The cost to go from row i in one of four states (nothing yet, after s, after u, after a) is a vector; a row maps the vector
behind it to its own by a min-plus linear map. Rows are range-partitioned by (conversation, turn), so a conversation of any
length is spread over tasks and cut into chunks of at most ``CHUNK_ROWS`` rows. One that lies whole inside a task and a
chunk is solved there. The others go on as chunks:

1. every chunk runs from a speculative vector behind its last row (the last chunk from the true one);
2. fix-up passes: a chunk whose vector from the right differs from the one it used by more than a constant is run
   again from there, until its vectors differ from the stored ones only by a constant, from where the stored ones hold.
   Passes end when no chunk's left vector changes. Chunks that do not converge within ``MAX_PASSES`` (long
   runs of rows that must all go keep any vector apart) get theirs from chunk matrices, composed along the conversation;
3. stitched costs drive the trace: a chunk traces from all four states, the chunk ends are chained, and every chunk traces
   its part again from the state it is entered in. The digest runs over the parts in order, one chunk in memory at a time.

Duplicates across chunks meet as distinct 128-bit keys, one per chunk and key, so a text that half of a conversation
repeats costs one row per chunk.

Defined cases. A null role or text is one space, so a null text is blank. Null turns come first; rows of equal turn are
ordered by role, then text (its first 64 characters, then its sha256, all bytewise). A null conversation id is a
conversation of its own. Empty roles have no initial and are never kept. A conversation whose rows are all absent has
zeros, an empty audit and the digest of the empty string. Repeated rows are duplicates. Further columns are ignored. A
chunk holds at least one row, however long its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import pick, release, stored
from candela.llm.ranked import spread_in_order

CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20
MAX_PASSES = 8
START, S, U, A = range(4)
INSERT = (U, U, A, U)  # the state after a user or assistant row, by the state before
KEEP = ({"s": S, "u": U}, {"u": U}, {"a": A}, {"u": U})
CLASSES = "sua"  # other initials: 3
MUST_GO, CUT_OFF = 4, 8
END = (0, 6, 3, 0)  # insertions that complete the pattern from each state
FAR = 1 << 40
SPECULATIVE = END


def closed(v: list[int]) -> list[int]:
    """Costs with insertions before the row."""
    for _ in range(2):
        v = [min(v[s], 3 + v[INSERT[s]]) for s in range(4)]
    return v


def stay(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up the row: letter, cost, next state."""
    out = [("D", 4, state)]
    if not code & MUST_GO:
        extra = 3 if code & CUT_OFF else 0
        kind = code & 3
        if kind < 3 and CLASSES[kind] in KEEP[state]:
            out.append(("K", extra, KEEP[state][CLASSES[kind]]))
        out.append(("R", 3 + extra, INSERT[state]))
    return out


def row_step(code: int, v) -> list[int]:
    return closed([min(c + v[t] for _, c, t in stay(code, s)) for s in range(4)])


class Viterbi:
    """Backward vectors, normalised to a least entry of 0, and traces; steps are kept by (code, vector)."""

    def __init__(self):
        self.steps: dict = {}
        self.moves: dict = {}

    def step(self, code: int, v: tuple) -> tuple[tuple, int]:
        got = self.steps.get((code, v))
        if got is None:
            w = row_step(code, v)
            low = min(w)
            got = self.steps[code, v] = (tuple(x - low for x in w), low)
        return got

    def backward(self, codes: bytes, right: tuple, old: np.ndarray | None = None) -> tuple[np.ndarray, int]:
        """Vectors and rises (n x 5) of the rows, from the vector ``right`` behind the last; with the vectors of an
        earlier run, only until they agree. Also the number of rows that were run."""
        n = len(codes)
        out = np.zeros((n, 5), np.uint8) if old is None else old.copy()
        v = right
        for i in range(n - 1, -1, -1):
            v, rise = self.step(codes[i], v)
            if old is not None and tuple(old[i, :4].tolist()) == v:
                out[i, 4] = rise
                return out, n - i
            out[i, :4] = v
            out[i, 4] = rise
        return out, n

    def move(self, code: int, state: int, here: tuple, rise: int, behind: tuple) -> tuple[str, int, int]:
        """Letters from ``state`` before a row until the row is used up, their cost, the state reached."""
        key = (code, state, here, rise, behind)
        got = self.moves.get(key)
        if got is None:
            letters, cost, s = "", 0, state
            while True:
                options = [(letter, c, t, c + behind[t] - rise) for letter, c, t in stay(code, s)]
                options.append(("I", 3, INSERT[s], 3 + here[INSERT[s]]))
                letter, c, t, _ = min(o for o in options if o[3] == here[s])
                letters, cost, s = letters + letter, cost + c, t
                if letter != "I":
                    break
            got = self.moves[key] = (letters, cost, s)
        return got

    def trace(self, codes: bytes, vectors: np.ndarray, right: tuple, state: int) -> tuple[list[str], int, int]:
        """Letters per row, cost and last state, entered in ``state``."""
        rows = [tuple(x) for x in vectors[:, :4].tolist()] + [tuple(right)]
        rises = vectors[:, 4].tolist()
        out, total = [], 0
        for i, code in enumerate(codes):
            letters, cost, state = self.move(code, state, rows[i], rises[i], rows[i + 1])
            out.append(letters)
            total += cost
        return out, total, state


def finish(state: int) -> tuple[str, int]:
    """Insertions behind the last row and their cost."""
    return "I" * (END[state] // 3), END[state]


def normal(v) -> tuple:
    low = min(v)
    return tuple(int(x - low) for x in v)


def code_of(role: str, blank: bool, again: bool, cut: bool) -> int:
    kind = CLASSES.find(role[:1]) if role else -1
    return (3 if kind < 0 else kind) | (MUST_GO if blank or again else 0) | (CUT_OFF if cut and not (blank or again) else 0)


def written(letters: list[str], roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """Repaired rows ``role:text`` of a traced stretch, and the state behind it."""
    out = []
    for i, edits in enumerate(letters):
        for e in edits:
            if e == "K":
                state = KEEP[state][roles[i][:1]]
                out.append(f"{roles[i]}:{texts[i]}")
            elif e != "D":
                state = INSERT[state]
                out.append(f"{'user' if state == U else 'assistant'}:{texts[i] if e == 'R' else ''}")
    return out, state


def gaps_of(low, high, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _key(role: str, text: str) -> bytes:
    r = role.encode()
    return hashlib.blake2b(len(r).to_bytes(4, "big") + r + text.encode(), digest_size=16).digest()


class Rows:
    """Rows of one conversation as they come, sorted."""

    def __init__(self, conv):
        self.conv, self.size = conv, 0
        self.roles, self.texts, self.turns, self.blank, self.cut = [], [], [], [], []

    def add(self, turn, role, text, blank, cut):
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.blank.append(blank)
        self.cut.append(cut)
        self.size += len(text) + 16


def _solved(x: Rows, v: Viterbi) -> tuple:
    """Result row of a conversation held whole."""
    seen, codes, duplicate, cut = set(), bytearray(), 0, 0
    for role, text, blank, short in zip(x.roles, x.texts, x.blank, x.cut):
        again = not blank and (role, text) in seen
        seen.add((role, text))
        codes.append(code_of(role, blank, again, short))
        duplicate += again
        cut += short and not blank and not again
    turns = [t for t in x.turns if t is not None]
    gaps = gaps_of(turns[0], turns[-1], len(set(turns))) if turns else 0
    illegal = sum(not legal(a, b) for a, b in zip(x.roles, x.roles[1:]))
    vectors, _ = v.backward(bytes(codes), END)
    letters, cost, state = v.trace(bytes(codes), vectors, END, START)
    rows, state = written(letters, x.roles, x.texts, START)
    tail, more = finish(state)
    rows += written([tail], [""], [""], state)[0]
    digest = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return (x.conv, gaps, sum(x.blank), duplicate, cut, illegal, cost + more, "".join(letters) + tail, digest)


CHUNK = ("conv_id long, pid int, seq long, turns array<long>, roles array<string>, texts array<string>, blank array<boolean>, cut array<boolean>")
CHUNK_NAMES = [f.split()[0] for f in CHUNK.split(", ")]


def _chunker(chunk_rows: int, chunk_bytes: int):
    """For mapInArrow over sorted rows: solved conversations (``result``), and chunks of those that are long or may go on in
    another task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, v, seq = TaskContext.get().partitionId(), Viterbi(), 0
        held, first, parts, any_yet = None, True, 0, False
        done, chunks, load = [], [], 0

        def chunk(x: Rows):
            nonlocal seq, load
            chunks.append((x.conv, pid, seq, x.turns, x.roles, x.texts, x.blank, x.cut))
            seq += 1
            load += x.size

        def flush():
            nonlocal load
            result = pa.struct([pa.field(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in NAMES])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.bool_())]
            n, m = len(done), len(chunks)
            columns = [pa.array([dict(zip(NAMES, d)) for d in done] + [None] * m, result)]
            columns += [pa.array([None] * n + [c[i] for c in chunks], k) for i, k in enumerate(kinds)]
            done.clear()
            chunks.clear()
            load = 0
            return pa.RecordBatch.from_arrays(columns, names=["result", *CHUNK_NAMES])

        for batch in batches:
            for conv, turn, role, text, blank, cut, present in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not any_yet or conv != held.conv:
                    if any_yet:
                        if first or parts:
                            chunk(held)
                        else:
                            done.append(_solved(held, v))
                        first = False
                    held, parts, any_yet = Rows(conv), 0, True
                elif len(held.roles) >= chunk_rows or held.size >= chunk_bytes:
                    chunk(held)
                    held, parts = Rows(conv), parts + 1
                if present:
                    held.add(turn, role, text, blank, cut)
                if load >= chunk_bytes or len(done) >= 4096:
                    yield flush()
        if any_yet:
            chunk(held)
        if done or chunks:
            yield flush()
        release()

    return run


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: str | None) -> DataFrame:
    types = {conv_col: "long", turn_col: "long", role_col: "string", text_col: "string"} | ({present: "boolean"} if present else {})
    d = pick(rows, **types).toDF(*["conv_id", "turn", "role", "text", "present"][: len(types)])
    if not present:
        d = d.withColumn("present", F.lit(True))
    d = d.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" ")), "present": F.coalesce("present", F.lit(False))})
    blank = ~F.col("text").rlike(r"[^ \t\n\x0B\f\r]")
    cut = ~blank & ~F.col("text").rlike(r"[.!?][ \t\n\x0B\f\r]*\z")
    return d.select("conv_id", "turn", "role", "text", blank.alias("blank"), cut.alias("cut"), "present", F.substring("text", 1, 64).alias("_head"), F.sha2("text", 256).alias("_sha"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           present: str | None = None, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``present`` names a boolean column; rows where it is not true count only as a sign that the conversation exists."""
    d = _prepared(rows, conv_col, turn_col, role_col, text_col, present)
    order = ["conv_id", "turn", "role", "_head", "_sha"]
    spread = spread_in_order(d, order, rows.count()).drop("_head", "_sha")
    first = stored(spread.mapInArrow(_chunker(chunk_rows, chunk_bytes), f"result struct<{', '.join(f.replace(' ', ':') for f in RESULT.split(', '))}>, {CHUNK}"), "conversations")
    whole = first.where("result is not null").select("result.*")
    return whole.unionByName(_long(first.where("result is null").select(*CHUNK_NAMES), max_passes))


# --- conversations in several chunks ------------------------------------------------------------

STATS = ("blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long, first_turn long, first_role string, last_role string, rows long")
STAT_NAMES = [f.split()[0] for f in STATS.split(", ")]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (role, text) of every chunk."""
    for batch in batches:
        for ck, pid, seq, roles, texts in zip(*(batch.column(i).to_pylist() for i in range(5))):
            keys = list({_key(r, t) for r, t in zip(roles, texts)})
            n = len(keys)
            yield pa.RecordBatch.from_arrays([pa.array([ck] * n, pa.string()), pa.array([pid] * n, pa.int32()), pa.array([seq] * n, pa.int64()), pa.array(keys, pa.binary())],
                                             names=["ck", "pid", "seq", "key"])


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row codes and figures of every chunk."""
    names = ["ck", "pid", "seq", "turns", "roles", "texts", "blank", "cut", "earlier"]
    for batch in batches:
        for row in batch.select(names).to_pylist():
            seen = set(row["earlier"] or ())
            codes, duplicate, short = bytearray(), 0, 0
            for role, text, blank, cut in zip(row["roles"], row["texts"], row["blank"], row["cut"]):
                key = _key(role, text)
                again = not blank and key in seen
                seen.add(key)
                codes.append(code_of(role, blank, again, cut))
                duplicate += again
                short += cut and not blank and not again
            turns = [t for t in row["turns"] if t is not None]
            stats = (sum(row["blank"]), duplicate, short, sum(not legal(a, b) for a, b in zip(row["roles"], row["roles"][1:])), min(turns, default=None),
                     max(turns, default=None), len(set(turns)), turns[0] if turns else None, *((row["roles"][0], row["roles"][-1]) if codes else (None, None)), len(codes))
            kinds = [pa.string() if n.endswith("role") else pa.int64() for n in STAT_NAMES]
            yield pa.RecordBatch.from_arrays([pa.array([row["ck"]]), pa.array([row["pid"]], pa.int32()), pa.array([row["seq"]], pa.int64()), pa.array([bytes(codes)], pa.binary())]
                                             + [pa.array([s], k) for s, k in zip(stats, kinds)], names=["ck", "pid", "seq", "codes", *STAT_NAMES])


RUN = "ck string, idx long, last boolean, codes binary, vectors binary, behind array<int>, left array<int>, changed boolean, ran long"


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pass: chunks with a new vector behind them (``want``) are run from it, the others stay as they are."""
    v = Viterbi()
    names = ["ck", "idx", "last", "codes", "vectors", "behind", "left", "want"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_(), pa.int64()]
    for batch in batches:
        out = []
        for ck, idx, last, codes, vectors, behind, left, want in zip(*(batch.select(names).column(i).to_pylist() for i in range(8))):
            if want is None or (behind is not None and tuple(behind) == tuple(want)):
                out.append((ck, idx, last, codes, vectors, behind, left, False, 0))
                continue
            old = None if vectors is None else np.frombuffer(vectors, np.uint8).reshape(-1, 5)
            new, ran = v.backward(codes, tuple(want), old)
            now = new[0, :4].tolist() if len(codes) else list(want)
            out.append((ck, idx, last, codes, new.tobytes(), list(want), now, left is None or now != list(left), ran))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds],
                                         names=["ck", "idx", "last", "codes", "vectors", "behind", "left", "changed", "ran"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Min-plus matrix of every chunk: rows by the state before, columns by the state behind."""
    for batch in batches:
        cks, ids, out = batch.column("ck").to_pylist(), batch.column("idx").to_pylist(), []
        for codes in batch.column("codes").to_pylist():
            columns = []
            for t in range(4):
                v = [0 if s == t else FAR for s in range(4)]
                for code in reversed(codes):
                    v = row_step(code, v)
                columns.append([min(x, FAR) for x in v])
            out.append([columns[t][s] for s in range(4) for t in range(4)])
        yield pa.RecordBatch.from_arrays([pa.array(cks, pa.string()), pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["ck", "idx", "matrix"])


def _compose(table: pa.Table) -> pa.Table:
    """The vector behind every chunk of a conversation, from the chunk matrices (16 numbers a chunk)."""
    table = table.sort_by([("idx", "descending")])
    v, want = list(END), []
    for m in table.column("matrix").to_pylist():
        want.append(normal(v))
        v = [min(min(m[4 * s + t] + v[t] for t in range(4)), FAR) for s in range(4)] if m is not None else v
        v = list(normal(v))
    return pa.table({"ck": table.column("ck"), "idx": table.column("idx"), "want": pa.array(want, pa.list_(pa.int32()))})


def _converged(chunks: DataFrame, max_passes: int) -> DataFrame:
    """chunks (ck, idx, last, codes) -> with the vectors of all rows and the true vector behind the chunk."""
    spec, end = (F.array(*[F.lit(x) for x in v]).cast("array<int>") for v in (SPECULATIVE, END))
    blank = chunks.withColumns({"vectors": F.lit(None).cast("binary"), "behind": F.lit(None).cast("array<int>"), "left": F.lit(None).cast("array<int>")})
    state = stored(blank.withColumn("want", F.when(F.col("last"), end).otherwise(spec)).mapInArrow(_run, RUN), "viterbi")
    for _ in range(max_passes):
        borders = state.select("ck", (F.col("idx") - 1).alias("idx"), F.col("left").alias("want"))
        state = stored(state.drop("changed", "ran").join(borders, ["ck", "idx"], "left").mapInArrow(_run, RUN), "viterbi")
        if not state.where("changed").limit(1).count():
            return state
    matrices = state.select("ck", "idx", "codes").mapInArrow(_matrices, "ck string, idx long, matrix array<long>")
    want = matrices.groupBy("ck").applyInArrow(_compose, "ck string, idx long, want array<int>")
    return stored(state.drop("changed", "ran").join(want, ["ck", "idx"]).mapInArrow(_run, RUN), "viterbi")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state behind a chunk for each state before it."""
    v = Viterbi()
    for batch in batches:
        cks, ids, out = batch.column("ck").to_pylist(), batch.column("idx").to_pylist(), []
        for codes, vectors, behind in zip(*(batch.column(c).to_pylist() for c in ("codes", "vectors", "behind"))):
            table = np.frombuffer(vectors, np.uint8).reshape(-1, 5)
            out.append([v.trace(codes, table, tuple(behind), s)[2] for s in range(4)])
        yield pa.RecordBatch.from_arrays([pa.array(cks, pa.string()), pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int32()))], names=["ck", "idx", "ends"])


def _chained(table: pa.Table) -> pa.Table:
    """The state before every chunk of a conversation, from the ends of the chunks (four numbers a chunk)."""
    table = table.sort_by("idx")
    state, out = START, []
    for ends in table.column("ends").to_pylist():
        out.append(state)
        state = ends[state]
    return pa.table({"ck": table.column("ck"), "idx": table.column("idx"), "state": pa.array(out, pa.int32())})


PIECE = "ck string, conv_id long, idx long, cost long, audit string, repaired array<string>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Traced part of every chunk."""
    v = Viterbi()
    names = ["ck", "conv_id", "idx", "last", "codes", "vectors", "behind", "state", "roles", "texts"]
    for batch in batches:
        for ck, conv, idx, last, codes, vectors, behind, state, roles, texts in zip(*(batch.select(names).column(i).to_pylist() for i in range(10))):
            letters, cost, _ = v.trace(codes, np.frombuffer(vectors, np.uint8).reshape(-1, 5), tuple(behind), state)
            rows, state = written(letters, roles, texts, state)
            if last:
                tail, more = finish(state)
                rows, cost = rows + written([tail], [""], [""], state)[0], cost + more
                letters.append(tail)
            yield pa.RecordBatch.from_arrays([pa.array([ck], pa.string()), pa.array([conv], pa.int64()), pa.array([idx], pa.int64()), pa.array([cost], pa.int64()),
                                              pa.array(["".join(letters)], pa.string()), pa.array([rows], pa.list_(pa.string()))], names=[f.split()[0] for f in PIECE.split(", ")])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and place -> one row per conversation; only one piece is held."""
    now, digest, audit, cost, conv, empty = None, None, [], 0, None, True

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([conv], pa.int64()), pa.array([cost], pa.int64()), pa.array(["".join(audit)], pa.string()),
                                           pa.array([digest.hexdigest()], pa.string())], names=["ck", "conv_id", "cost", "audit", "repaired_sha256"])

    for batch in batches:
        for i in range(batch.num_rows):
            ck = batch.column(0)[i].as_py()
            if ck != now:
                if now is not None:
                    yield row()
                now, digest, audit, cost, conv, empty = ck, hashlib.sha256(), [], 0, batch.column(1)[i].as_py(), True
            cost += batch.column(3)[i].as_py()
            audit.append(batch.column(4)[i].as_py())
            for text in batch.column(5)[i].as_py():
                digest.update(("" if empty else "\n").encode() + text.encode())
                empty = False
    if now is not None:
        yield row()


def _long(chunks: DataFrame, max_passes: int) -> DataFrame:
    keyed = chunks.withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    keys = stored(keyed.select("ck", "pid", "seq", "roles", "texts").mapInArrow(_keys, "ck string, pid int, seq long, key binary"), "keys")
    first = keys.groupBy("ck", "key").agg(F.min(F.struct("pid", "seq")).alias("_first"))
    later = keys.join(first, ["ck", "key"]).where(F.struct("pid", "seq") > F.col("_first"))
    earlier = later.groupBy("ck", "pid", "seq").agg(F.collect_list("key").alias("earlier"))
    coded = keyed.drop("conv_id").join(earlier, ["ck", "pid", "seq"], "left").mapInArrow(_coded, f"ck string, pid int, seq long, codes binary, {STATS}")
    coded = stored(coded, "coded")
    # one narrow row per chunk, ordered along the conversation
    along = Window.partitionBy("ck").orderBy("pid", "seq")
    places = coded.select("ck", "pid", "seq").withColumn("idx", F.row_number().over(along).cast("long")).withColumn("last", F.lead("seq").over(along).isNull())
    chain = coded.join(places, ["ck", "pid", "seq"])
    chain = stored(chain.select("ck", "pid", "seq", "idx", "last", "codes"), "chain")
    state = _converged(chain.select("ck", "idx", "last", "codes"), max_passes)
    ends = state.select("ck", "idx", "codes", "vectors", "behind").mapInArrow(_ends, "ck string, idx long, ends array<int>")
    starts = ends.groupBy("ck").applyInArrow(_chained, "ck string, idx long, state int")
    ready = (keyed.select("ck", "conv_id", "pid", "seq", "roles", "texts").join(chain.select("ck", "pid", "seq", "idx"), ["ck", "pid", "seq"])
             .join(state.drop("changed", "ran", "left"), ["ck", "idx"]).join(starts, ["ck", "idx"]))
    pieces = stored(ready.mapInArrow(_pieces, PIECE), "pieces")
    text = pieces.repartition("ck").sortWithinPartitions("ck", "idx").mapInArrow(_joined, "ck string, conv_id long, cost long, audit string, repaired_sha256 string")
    figures = coded.where("rows > 0").select("ck", *STAT_NAMES, F.lag("last_role").over(along).alias("_role"), F.max("high").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_turn"))
    pair = F.concat(F.substring("_role", 1, 1), F.substring("first_role", 1, 1))
    broken = F.when(F.col("_role").isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)
    figures = figures.groupBy("ck").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"), F.sum(F.col("illegal") + broken).alias("illegal"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("distinct") - F.when(F.col("_turn") == F.col("first_turn"), 1).otherwise(0)), F.lit(0)).alias("gaps"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal")}
    return text.join(figures, "ck", "left").withColumns(zero).select(*NAMES)


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the test query: by crc32 of ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1), stripped of
    ``[.!?]`` (2), repeated (3) or given the role user (4). Nulls are one space there. Dropped rows stay as absent ones."""
    d = pick(rows, conv_id="long", turn="long", role="string", text="string")
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce("text", space)
    d = d.withColumns({"kind": kind, "text": F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
                       "role": F.when(kind == 4, "user").otherwise(F.coalesce("role", space))})
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return d.withColumn("_copy", copies).select("conv_id", "turn", "role", "text", (F.col("kind") != 0).alias("present"))
