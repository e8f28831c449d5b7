import hashlib
import random

import pytest

from candela.llm import conversations as C

SCHEMA = "conv_id long, turn long, ROLE string, role string, text string, Conv string, seq long, here boolean"
WHITE = " \t\n\x0b\x0c\r"


def best_edits(kinds):
    """Plain backward search over whole edit strings; kinds: (initial, must go, truncated)."""
    states = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    new = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(v):
        for _ in range(4):
            v = {s: min(v[s], (v[new[s]][0] + 3, "I" + v[new[s]][1])) for s in v}
        return v

    v = insert({"": (0, ""), "s": (10**9, ""), "u": (10**9, ""), "a": (0, "")})
    for initial, must, cut in reversed(kinds):
        w = {}
        for s in states:
            ways = [(v[s][0] + 4, "D" + v[s][1])]
            if not must:
                extra = 3 if cut else 0
                ways.append((v[new[s]][0] + 3 + extra, "R" + v[new[s]][1]))
                if initial in states[s]:
                    to = states[s][initial]
                    ways.append((v[to][0] + extra, "K" + v[to][1]))
            w[s] = min(ways)
        v = insert(w)
    return v[""]


def plain(conv, rows):
    """rows (turn, role, text) of one conversation, nulls filled."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    seen, kinds, n = set(), [], [0, 0, 0]
    for _, role, text in rows:
        solid = text.strip(WHITE)
        blank = not solid
        again = not blank and (role, text) in seen
        cut = not blank and not again and solid[-1] not in ".!?"
        seen.add((role, text))
        n = [n[0] + blank, n[1] + again, n[2] + cut]
        kinds.append((role[:1], blank or again, cut))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = best_edits(kinds) if rows else (0, "")
    out, at, total = [], 0, sum(e != "D" for e in audit)
    for e in audit:
        role = "user" if (len(out) - total % 2) % 2 == 0 else "assistant"
        if e == "I":
            out.append(f"{role}:")
            continue
        if e != "D":
            out.append(f"{rows[at][1] if e == 'K' else role}:{rows[at][2]}")
        at += 1
    return (conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def sample():
    r = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "sys"], ["Yes.", "No!", "why", "", " \n", None, "Well?  \t", "é", "x" * 300]
    rows = []
    for conv in [None, -1, *range(40)]:
        n = r.choice([1, 2, 3, 5, 9])
        weights = r.choice([(5, 5, 1, 0, 0, 0, 0), (1, 1, 1, 1, 1, 1, 1), (1, 8, 0, 0, 0, 0, 0), (8, 1, 3, 0, 0, 0, 0)])
        for t in range(n):
            rows.append((conv, r.choice([t, t, t, 2 * t, None, 3]), r.choices(roles, weights)[0], r.choice(texts) if r.random() < 0.4 else f"Turn {t} of {conv}{r.choice('.!? ,')}"))
    for t in range(90):  # long ones: alternating, one role, blanks, repeats, mixed
        rows += [(100, t, ("user", "assistant")[t % 2], f"m{t}."), (101, t, "user", f"m{t}."), (102, t, "user", " "), (103, t, "assistant", "same."),
                 (104, t, r.choice(roles[:3]), r.choice(texts)), (105, t // 2, ("user", "assistant")[(t // 30) % 2], "" if 20 < t < 70 else f"m{t}?")]
    rows += [(106, None, "user", "a."), (106, None, "user", "a."), (107, 5, "user", "y" * 20000 + "."), (107, 5, "user", "y" * 20000 + ".")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample()


@pytest.fixture(scope="module")
def frame(spark, rows):
    data = [(c, t, "x", role, text, "y", 1, True) for c, t, role, text in rows] + [(200, 1, "x", "user", "gone.", "y", 1, False), (100, 900, "x", "user", "gone.", "y", 1, None)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def expected(rows):
    groups = {200: []}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return sorted((plain(c, g) for c, g in groups.items()), key=repr)


@pytest.mark.parametrize("chunk_rows,passes", [(4096, 8), (7, 8), (5, 0), (1, 1)])
def test_equals_plain_search_over_any_chunks(frame, expected, chunk_rows, passes):
    got = C.repair(frame, present="here", chunk_rows=chunk_rows, max_passes=passes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected


def test_long_texts_cut_chunks_by_bytes(frame, expected):
    got = C.repair(frame, present="here", chunk_bytes=1000).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected


def test_fix_up_stops_where_vectors_are_parallel():
    v, codes = C.Viterbi(), bytes([1, 2] * 200)
    old, _ = v.backward(codes, C.SPECULATIVE)
    right = C.normal((3, 0, 5, 2))
    new, ran = v.backward(codes, right, old)
    whole, _ = v.backward(codes, right)
    assert ran < 20 and (new == whole).all()
    stuck = bytes([C.MUST_GO] * 50)  # rows that must go keep vectors apart
    old, _ = v.backward(stuck, C.SPECULATIVE)
    assert v.backward(stuck, right, old)[1] == 50


def test_vectors_stay_small():
    r, v = random.Random(1), C.Viterbi()
    for _ in range(50):
        codes = bytes(r.randrange(16) for _ in range(300))
        vectors, _ = v.backward(codes, C.END)
        assert vectors.max() < 30


def test_damage_and_empty_table(spark):
    import zlib
    rows = [(c, t, "system", "Hi. Yes?") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    df = spark.createDataFrame([(c, t, "x", r, x, "y", 1, True) for c, t, r, x in rows], SCHEMA)
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text, k != 0)
        want += [row] * (2 if k == 3 else 1)
    assert sorted(map(tuple, C.damaged(df).collect()), key=repr) == sorted(want, key=repr)
    assert C.repair(spark.createDataFrame([], SCHEMA)).count() == 0
