import random

import pytest
import xxhash
from tests.llm.conftest import rows_of

from candela.llm.components import components
from candela.llm.simhash import fingerprint, keep_one, links, near_duplicates


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits):
    """Smallest number reachable for each of the fingerprints, by flooding."""
    left, out = set(range(len(fps))), {}
    while left:
        todo, seen = [min(left)], set()
        left -= {todo[0]}
        while todo:
            x = todo.pop()
            seen.add(x)
            near = {y for y in left if (fps[x] ^ fps[y]).bit_count() <= bits}
            left -= near
            todo += near
        out |= {x: min(seen) for x in seen}
    return out


def test_fingerprints_and_components(docs, corpus):
    fps = [plain_fingerprint(t) for _, t in corpus]
    group = plain_components(fps, 2)
    least = {}
    for x, (i, _) in enumerate(corpus):
        if i is not None:
            least[group[x]] = min(least.get(group[x], i), i)
    want = sorted(((i, f"{fps[x]:016x}", least.get(group[x])) for x, (i, _) in enumerate(corpus)), key=repr)
    assert rows_of(near_duplicates(docs)) == want


@pytest.mark.parametrize(("bits", "dense"), [(2, 1024), (2, 2), (1, 3), (3, 4), (0, 9)])
def test_links_connect_what_brute_force_connects(spark, bits, dense):
    r = random.Random(bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        base = r.getrandbits(64)
        fps |= {base} | {base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(40)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, dense=dense)
    for a, b in edges.distinct().collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits
    got = {n: root for n, root in components(edges).collect()}
    group = plain_components(fps, bits)
    label = [got.get(s, s) for s in signed]
    for x in range(len(fps)):
        for y in range(x):
            assert (label[x] == label[y]) == (group[x] == group[y])


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (1049, 2000)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 50)} | {2000: 1000}


def test_keep_one(docs, corpus):
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    fps = [plain_fingerprint(t) for _, t in corpus]
    group = plain_components(fps, 2)
    want = {}
    for x, (i, _) in enumerate(corpus):
        want.setdefault(group[x], []).append((i is None, i or 0))
    assert sorted(((r[0] is None, r[0] or 0) for r in kept.collect())) == sorted(min(v) for v in want.values())


def test_empty_and_long(no_docs):
    assert near_duplicates(no_docs).collect() == []
    assert keep_one(no_docs).collect() == []
    long = " ".join(str(i % 977) for i in range(40_000))
    assert fingerprint(long.encode(), 3) == plain_fingerprint(long)
