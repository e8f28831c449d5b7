import hashlib
import random
import re

import numpy as np
import pytest
from tests.llm.conftest import rows_of

from candela.llm.decontaminate import find_contamination, remove_contaminated, suffix_array, verbatim_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def items(corpus):
    r = random.Random(2)
    out = []
    for k in range(20):
        w = (corpus[k * 3][1] or "").split()
        s = r.randint(0, max(0, len(w) - 25))
        out.append((k, " ".join(w[s:s + r.randint(8, 25)])))
    return out + [(100, None), (101, ""), (102, "one"), (3, "TWO WORDS"), (None, " ".join(corpus[1][1].split()[:12])), out[0], (0, "never seen words in any document " * 4), (55, out[0][1]),
                  (56, "na " * 14)]


def plain(corpus, items, k):
    out = []
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(k, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + n]), set()).add(i)
    sizes = {len(x) for x in windows}
    for i, t in corpus:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                found = windows.get(tuple(w[j:j + n]))
                if found:
                    hit.update(range(j, j + n))
                    ids |= {str(x) for x in found if x is not None}
        ids = sorted(ids)
        out.append((i, len(w), len(hit), len(ids), ids, hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "chunk"), [(10, 1 << 20), (10, 600), (2, 1 << 20)])
def test_equals_brute_force(spark, docs, corpus, items, window, chunk):
    table = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(docs, table, window=window, chunk_bytes=chunk)
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "n_items", "item_ids", "items_sha256", "contaminated")) == plain(corpus, items, window)


def test_shared_item_text_costs_no_product():
    """A sentence that 3,000 items share against 1,500 documents that hold it: an occurrence is one entry, however many
    items own it, and the documents share one list of items."""
    import tracemalloc

    import pyarrow as pa

    from candela.llm.decontaminate import Shard, Tests, _hits, _summary
    shared = " ".join(f"common{i}" for i in range(16))
    items_ = pa.table({"item_id": pa.array([str(k) for k in range(3000)]), "text": pa.array([f"{shared} question number {k}" for k in range(3000)])})
    texts = [f"intro {i} {shared} end" for i in range(1500)]
    tests = Tests(items_, 10)
    tracemalloc.start()
    shard = Shard([t.encode() for t in texts])
    found = _hits(shard, tests)
    out = _summary(pa.table({"doc_id": pa.array(range(1500), pa.int64())}), shard, found, "doc_id", False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found.word) == 1500 * 7 and set(out["n_items"].to_pylist()) == {3000} and set(out["n_hit"].to_pylist()) == {16}
    assert out["items_sha256"][0].as_py() == hashlib.sha256(",".join(sorted(str(k) for k in range(3000))).encode()).hexdigest()
    assert peak < 60 << 20, peak


def test_many_chunks_stay_off_the_driver(spark, docs, corpus, items, monkeypatch):
    """Beyond the bound of the broadcast, one of the items long: chunks reach the tasks as rows of one product of chunks
    and blocks; the driver collects no item, and no plan broadcasts."""
    from pyspark.sql.classic.dataframe import DataFrame

    from candela.llm import decontaminate
    plans, keep = [], decontaminate.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)

    def refused(self):
        raise AssertionError("items collected")

    monkeypatch.setattr(decontaminate, "stored", watched)
    monkeypatch.setattr(DataFrame, "toArrow", refused)
    more = items + [(900, " ".join(f"long{i}" for i in range(3000))), (901, corpus[3][1])]
    found = find_contamination(docs, spark.createDataFrame(more, "item_id long, text string"), chunk_bytes=600)
    assert rows_of(found.select("doc_id", "n_words", "n_hit", "n_items", "item_ids", "items_sha256", "contaminated")) == plain(corpus, more, 10)
    assert [n for n, _ in plans] == ["items", "chunks", "matches"]
    assert "CartesianProduct" in dict(plans)["matches"] and not any("Broadcast" in x for _, x in plans)


def test_longest_matches(spark, docs, corpus, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    by_id = {}
    for i, t in corpus:
        by_id.setdefault(i, []).append(words(t))
    texts = {}
    for i, t in items:
        texts.setdefault(str(i), []).append(" " + " ".join(words(t)) + " ")
    seen = 0
    for i, ids, at, n in (tuple(r) for r in verbatim_matches(docs, table).collect()):
        seen += 1
        for item in ids:
            assert any(" " + " ".join(w[at:at + n]) + " " in x for w in by_id[i] for x in texts[item])
    assert seen > 10


def test_removed_documents(spark, docs, corpus, items, no_docs):
    table = spark.createDataFrame(items, "item_id long, text string")
    out = remove_contaminated(docs, table)
    assert out.columns == docs.columns
    bad = [r[0] for r in plain(corpus, items, 10) if r[-1]]
    good = [r[0] for r in plain(corpus, items, 10) if not r[-1]]
    assert bad and sorted((r[0] for r in out.collect()), key=repr) == sorted(good, key=repr)
    assert find_contamination(no_docs, table).collect() == []
    none = find_contamination(docs, table.where("item_id = -1"))
    assert none.where("contaminated or n_hit > 0 or n_items > 0").count() == 0 and none.count() == len(corpus)


def test_suffix_array_order():
    r = np.random.default_rng(1)
    code = np.concatenate((r.integers(0, 3, 300), np.zeros(9, np.int64)))
    got = suffix_array(code, 8)

    def suffix(i):
        out = []
        for x in code[i:i + 8]:
            if not x:
                break
            out.append(x)
        return out

    keys = [suffix(i) for i in got]
    assert keys == sorted(keys) and sorted(got) == np.flatnonzero(code).tolist()
