import hashlib
import re

from tests.llm.conftest import rows_of

from candela.llm.substring_dedup import remove_repeats, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(corpus, k):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in corpus]
    for i, w in split:
        if i is not None:
            for j in range(len(w) - k + 1):
                key = tuple(w[j:j + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for j in range(len(w) - k + 1):
            if i is not None and first[tuple(w[j:j + k])] < i:
                gone.update(range(j, j + k))
        text = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), text, hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_equals_brute_force_over_many_blocks(docs, corpus):
    want = sorted(plain(corpus, 13), key=repr)
    assert rows_of(substring_dedup(docs, block_bytes=3000)) == want
    assert rows_of(substring_dedup(docs, block_bytes=20_000, shard_words=50, anchor=5)) == want


def test_other_windows(docs, corpus):
    assert rows_of(substring_dedup(docs, window=3, anchor=3, block_bytes=9000)) == sorted(plain(corpus, 3), key=repr)
    assert rows_of(substring_dedup(docs, window=1, anchor=1)) == sorted(plain(corpus, 1), key=repr)


def test_empty_table(no_docs):
    assert substring_dedup(no_docs).collect() == []
    assert remove_repeats(no_docs).collect() == []


def test_rewritten_documents_keep_all_columns(docs, corpus):
    out = remove_repeats(docs, block_bytes=5000)
    assert out.columns == docs.columns
    want = sorted(((i, t if not n else kept) for (i, t), (_, _, n, kept, _) in zip(corpus, plain(corpus, 13))), key=repr)
    got = [(r[0], r[2]) for r in out.collect()]
    assert sorted(got, key=repr) == want
    assert {tuple(r)[:2][1] for r in out.collect()} == {"other"}
