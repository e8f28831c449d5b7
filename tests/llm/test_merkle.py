import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from candela.llm import merkle

SCHEMA = "doc_id long, Text string, text string, lang string, LANG string, source string, n_chars long, pos long, g string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels_of(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def siblings(levels, i, fan):
    out = []
    for level in levels[:-1]:
        a = i - i % fan
        out.append((level[a : a + fan], i - a))
        i //= fan
    return out


def plain(rows, fan):
    """rows (doc_id, text, lang, source, n_chars) -> result rows, by the definition."""
    leaf = lambda r, t: h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(t))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: b"" if x is None else b"+" + x.encode())
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[g] = levels_of([leaf(r, r[1]) for r in groups[g]], fan)
    top = levels_of([trees[g][-1][0] for g in langs], fan)
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            runs = siblings(trees[g], i, fan) + siblings(top, k, fan)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = r[1] if r[1] is None or not hit else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            node = leaf(r, text)
            for run, at in runs:
                node = h(*run[:at], node, *run[at + 1 :])
            proof = h(*[x for run, at in runs for j, x in enumerate(run) if j != at])
            out.append((r[0], leaf(r, r[1]), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def sample(n):
    rows = [(i * 7 % n, f"Text Number {i} É\n", ["en", "fr", None, "é", "z" * 3][0 if i % 3 else i % 5], "web", i) for i in range(n)]
    rows += [(None, "No Id", "en", None, None), (None, None, None, None, None), (9, None, "only", "x", 1), (9001, "", "fr", "", 0), (9002, "ABC " * 5000, "en", "web", 20000),
             (9004, "Twice", "fr", "web", 5), (9004, "Twice", "fr", "web", 5), (9004, "Other", "fr", "web", 5), (-12, "-", "-", "-", -1)]
    return rows + [(20000 + i, "L", f"lang{i:02d}", None, 1) for i in range(20)]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, "x", t, lang, "other", s, c, 1, "g") for i, t, lang, s, c in rows], SCHEMA).repartition(3)
    out = merkle.manifest(merkle.document_leaves(df), **kw)
    return out.withColumn("p", F.sha2(F.array_join("proof", ""), 256)).withColumn("ok", F.col("folded_root") == F.col("root"))


@pytest.mark.parametrize("fan,levels", [(8, 1), (8, 4), (2, 2)])
def test_equals_the_definition_over_any_blocks(spark, fan, levels):
    rows = sample(150)
    got = run(spark, rows, fan=fan, levels=levels).select("doc_id", "leaf", "subroot", "root", "p", "folded_root", "ok").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, fan)


def test_versions_copy_ancestors_only(spark):
    rows = run(spark, sample(150), fan=2, levels=2).collect()
    assert any(r.copied for r in rows) and any(r.copied is None for r in rows)
    for r in rows:
        if r.copied is not None:
            assert len(r.copied) <= 8 + 6 + 1 and r.copied[-1] == r.folded_root
            assert (r.folded_root == r.root) == (r.copied[0] == r.leaf)
        else:
            assert r.folded_root == r.root


def test_a_version_shares_untouched_nodes():
    tree = merkle.Tree([merkle.digest([str(i).encode()]) for i in range(70)])
    own = tree.version(64, b"f" * 64)
    assert len(own) == 4 and own[0] == b"f" * 64
    assert own[1] == merkle.digest([b"f" * 64, *tree.levels[0][65:70]])
    assert own[2] == merkle.digest([own[1]]) and own[3] == merkle.digest([tree.levels[2][0], own[2]])
    assert tree.version(64, tree.levels[0][64])[-1] == tree.top


def test_no_rows_and_one_row(spark):
    assert run(spark, []).count() == 0
    only = run(spark, [(5, "A", None, None, None)]).first()
    assert only.leaf == only.subroot == only.root and only.proof == [] and only.leaf == h("1:5", "-", "-", "-", "1:A")
