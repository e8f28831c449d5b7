"""Training suffix arrays: find verbatim passages of test items in training documents.

A task turns a shard of documents into word numbers (the test items' words; 0 for any other) and sorts the
suffixes that can hold a test window: those inside runs of test words no shorter than the shortest window.
Sorting is by prefix doubling up to the longest item. Every test suffix is binary-searched in every shard for
its first ``window`` words (all of them for shorter items); neighbouring hits on one diagonal join into the
longest verbatim match with its place. Documents with a match are contaminated.

Which words are hit and which items occur is found per *distinct* window: a window that a thousand items share is
searched once, and an occurrence is one entry. Windows that occur in the same items form one owner set, so a document's
items are the union of a few sets. Longest matches per item, which do grow with items x occurrences, are made only by
``verbatim_matches``.

Normal form: A-Z lower-cased, words are runs of digits, letters and characters outside ASCII.

Test items of at most ``CHUNK_BYTES`` of text in all are broadcast: one pass without a shuffle. More are packed into
chunks of about that size (one longer item makes a larger chunk), and documents into blocks, both in the shared folder;
one job searches every (chunk, block) pair, and the matches of a block meet again at the block. Nothing of these
chunks passes through the driver.

Defined cases. Null document text: no words. Null item text: no window. Null item id: it hits words and
contaminates, but is in no list of ids and not counted. Items of equal id count once, however often repeated.
Null document ids and repeated rows stay rows. No items: nothing is hit. Further columns are ignored
(``find_contamination``) or kept (``remove_contaminated``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pack, packer, pick, read_table, release, replace_column, stored, stored_by_block, texts_of
from candela.llm.spans import WHITE, Spans, covered

CHUNK_BYTES = 8 << 20
SHARD_BYTES = 4 << 20
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Tests:
    """Distinct test texts (classes) of one chunk, their ids, and their windows."""

    def __init__(self, items: pa.Table, window: int):
        ids: dict[bytes, set] = {}
        for i, t in zip(items.column(0).to_pylist(), texts_of(items.column(1))):
            key = b" ".join(t.translate(NORMAL).split())
            if key:
                ids.setdefault(key, set()).update([] if i is None else [i])
        self.text = list(ids)
        self.ids = [sorted(x) for x in ids.values()]
        spans = Spans(self.text, WHITE)
        self.vocabulary, code = np.unique(spans.hashes(), return_inverse=True)
        sizes = np.diff(spans.first)
        self.longest = int(sizes.max(initial=1))
        width = np.minimum(sizes, window)
        self.shortest = int(width.min(initial=window))
        self.code = np.concatenate((code + 1, np.zeros(self.longest, np.int64)))
        n = sizes - width + 1
        self.cls = np.repeat(np.arange(len(sizes)), n)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.offset, self.at, self.width = offset, spans.first[:-1][self.cls] + offset, width[self.cls]
        self._distinct()

    def _distinct(self) -> None:
        """``one``: a window of each distinct content; ``owner``: its owner set; ``owners``: the sets' item ids, sorted."""
        reach = int(self.width.max(initial=1))
        inside = np.arange(reach)[None] < self.width[:, None]
        words = np.where(inside, self.code[self.at[:, None] + np.arange(reach)[None] * inside], 0)
        _, self.one, group = np.unique(words, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(group.ravel(), kind="stable")
        edge = np.searchsorted(group.ravel()[order], np.arange(len(self.one) + 1))
        sets: dict[bytes, int] = {}
        self.owner, self.owners = np.zeros(len(self.one), np.int64), []
        for g in range(len(self.one)):
            classes = np.unique(self.cls[order[edge[g] : edge[g + 1]]])
            place = sets.setdefault(classes.tobytes(), len(sets))
            if place == len(self.owners):
                self.owners.append(sorted({i for c in classes.tolist() for i in self.ids[c]}))
            self.owner[g] = place


def suffix_array(code: np.ndarray, depth: int) -> np.ndarray:
    """Places of non-zero entries, sorted by the entries that follow up to the next zero or ``depth``."""
    place = np.flatnonzero(code)
    rank = np.zeros(len(code) + depth + 1, np.int64)
    rank[place] = code[place]
    step = 1
    while step < depth:
        key = rank[place] * (int(rank.max()) + 1) + rank[place + step]
        _, new = np.unique(key, return_inverse=True)
        rank[place] = new + 1
        if len(new) and int(new.max()) + 1 == len(place):
            break
        step *= 2
    return place[np.argsort(rank[place], kind="stable")]


def _bounds(suffixes: np.ndarray, code: np.ndarray, tests: Tests, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the test windows ``which`` the range of the suffixes that start with them, by binary search."""
    m, starts, widths = len(which), tests.at[which], tests.width[which]

    def search(upper: bool) -> np.ndarray:
        low, high = np.zeros(m, np.int64), np.full(m, len(suffixes))
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live]) // 2
            after = np.full(len(live), not upper)  # equal: go on to the right for the upper bound only
            undecided = np.arange(len(live))
            for d in range(tests.longest):
                undecided = undecided[widths[live[undecided]] > d]
                if not len(undecided):
                    break
                x, y = code[suffixes[mid[undecided]] + d], tests.code[starts[live[undecided]] + d]
                after[undecided[x > y]] = True
                after[undecided[x < y]] = False
                undecided = undecided[x == y]
            high[live[after]] = mid[after]
            low[live[~after]] = mid[~after] + 1

    return search(False), search(True)


class Shard:
    """Normalised words of some documents."""

    def __init__(self, texts: list[bytes]):
        self.spans = Spans([t.translate(NORMAL) for t in texts], WHITE)
        self.hash = self.spans.hashes()
        self.row = self.spans.text_of_word()

    def _found(self, tests: Tests, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the windows ``which``: (place in ``which``, word)."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(which) or not len(self.hash):
            return none
        known = np.searchsorted(tests.vocabulary, self.hash)
        known[known == len(tests.vocabulary)] = 0
        code = np.where(tests.vocabulary[known] == self.hash, known + 1, 0)
        spread = np.zeros(len(code) + int(self.row[-1]) + 1 + tests.longest + 1, np.int64)  # a zero after each text
        home = np.arange(len(code)) + self.row
        spread[home] = code
        edge = np.flatnonzero(np.diff(np.concatenate(([0], spread != 0, [0])).astype(np.int8)))
        for a, b in zip(edge[0::2], edge[1::2]):
            if b - a < tests.shortest:
                spread[a:b] = 0
        suffixes = suffix_array(spread, tests.longest)
        if not len(suffixes):
            return none
        low, high = _bounds(suffixes, spread, tests, which)
        n = high - low
        test = np.repeat(np.arange(len(n)), n)
        where = suffixes[np.repeat(low, n) + np.arange(len(test)) - np.repeat(np.cumsum(n) - n, n)]
        return test, np.searchsorted(home, where)

    def hits(self, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of the distinct windows: owner set, word, width."""
        test, word = self._found(tests, tests.one)
        true = np.ones(len(test), bool)
        texts: dict[int, list[bytes]] = {}
        for i, (t, w) in enumerate(zip(test.tolist(), word.tolist())):
            if t not in texts:
                j = tests.one[t]
                texts[t] = tests.text[tests.cls[j]].split(b" ")[tests.offset[j] : tests.offset[j] + tests.width[j]]
            true[i] = [self.spans.word(k) for k in range(w, w + len(texts[t]))] == texts[t]  # the words behind the hashes
        return tests.owner[test[true]], word[true], tests.width[tests.one[test[true]]]

    def matches(self, tests: Tests):
        """Longest verbatim matches per item text: class, place in the item, place in the shard (word), length."""
        test, word = self._found(tests, np.arange(len(tests.at)))
        if not len(test):
            return (np.empty(0, np.int64),) * 4
        cls, offset = tests.cls[test], tests.offset[test]
        order = np.lexsort((word, word - offset, cls))
        cls, offset, word, width = cls[order], offset[order], word[order], tests.width[test][order]
        new = np.ones(len(cls), bool)
        new[1:] = (cls[1:] != cls[:-1]) | (word[1:] != word[:-1] + 1) | (offset[1:] != offset[:-1] + 1) | (self.row[word[1:]] != self.row[word[:-1]])
        head = np.flatnonzero(new)
        tail = np.concatenate((head[1:], [len(cls)])) - 1
        cls, offset, word, size = cls[head], offset[head], word[head], word[tail] + width[head] - word[head]
        true = np.array([self._equal(w, s, tests.text[c], o) for c, o, w, s in zip(cls.tolist(), offset.tolist(), word.tolist(), size.tolist())], bool)
        return cls[true], offset[true], word[true], size[true]

    def _equal(self, word: int, size: int, text: bytes, offset: int) -> bool:
        """Exact check of the words behind the hashes."""
        return [self.spans.word(i) for i in range(word, word + size)] == text.split(b" ")[offset : offset + size]


def _texts_of_items(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """The distinct test items that have a text."""
    return pick(items, **{item_id: "string", item_text: "string"}).dropna(subset=[item_text]).distinct()


class Found:
    """Occurrences in a shard: the owner set, word and width of each, and the owner sets' item ids."""

    def __init__(self, owner, word, size, owners: list[list[str]]):
        self.owner, self.word, self.size, self.owners = owner, word, size, owners

    def packed(self, block: int) -> pa.RecordBatch:
        """One row; only the owner sets that occur travel."""
        used, owner = np.unique(self.owner, return_inverse=True)
        lists = [pa.array([list(v)], pa.list_(pa.int64())) for v in (owner.ravel().tolist(), self.word.tolist(), self.size.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *lists, pa.array([[self.owners[o] for o in used.tolist()]], pa.list_(pa.list_(pa.string())))],
                                          names=["block", "owner", "word", "size", "owners"])

    @classmethod
    def joined(cls, rows: list[dict]) -> "Found":
        parts, owners = [[], [], []], []
        for r in rows:
            parts[0] += [len(owners) + o for o in r["owner"]]
            parts[1] += r["word"]
            parts[2] += r["size"]
            owners += r["owners"]
        return cls(*(np.array(p, np.int64) for p in parts), owners)


FOUND = "block long, owner array<long>, word array<long>, size array<long>, owners array<array<string>>"


def _summary(table: pa.Table, shard: Shard, found: Found, id_col: str, with_ids: bool) -> pa.Table:
    sp = shard.spans
    hit = covered(len(sp), found.word, found.word + found.size)
    total = np.concatenate(([0], np.cumsum(hit)))
    sets: dict[int, set] = {}
    for text, o in set(zip(shard.row[found.word].tolist(), found.owner.tolist())):
        sets.setdefault(text, set()).add(o)
    unions: dict[frozenset, tuple] = {}  # documents with the same owner sets share their list and its digest

    def union(text: int) -> tuple:
        key = frozenset(sets.get(text, ()))
        if key not in unions:
            ids = sorted({i for o in key for i in found.owners[o]})
            unions[key] = ids, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()
        return unions[key]

    lists = [union(t) for t in range(table.num_rows)]
    n_hit = total[sp.first[1:]] - total[sp.first[:-1]]
    columns = {
        id_col: table.column(id_col), "n_words": pa.array(np.diff(sp.first), pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([x[1] for x in lists], pa.int64()), "items_sha256": pa.array([x[2] for x in lists], pa.string()), "contaminated": pa.array(n_hit > 0, pa.bool_())}
    if with_ids:
        columns["item_ids"] = pa.array([x[0] for x in lists], pa.list_(pa.string()))
    return pa.table(columns)


def _hits(shard: Shard, tests: Tests) -> Found:
    return Found(*shard.hits(tests), tests.owners)


def _longest(shard: Shard, tests: Tests) -> Found:
    cls, _, word, size = shard.matches(tests)
    return Found(cls, word, size, tests.ids)


def _searched(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int, chunk_bytes: int, rows, schema, find=_hits) -> DataFrame:
    if window < 1:
        raise ValueError("window must be positive")
    spark = docs.sparkSession
    items = stored(_texts_of_items(items, item_id, item_text), "items")
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    if size <= chunk_bytes:  # the bound of the broadcast
        shared = spark.sparkContext.broadcast(items.toArrow())
        gather = packer(text_col, SHARD_BYTES)

        def direct(batches):
            tests = Tests(shared.value, window)
            for block in gather(batches):
                table = read_table(block.column("packed")[0].as_py())
                shard = Shard(texts_of(table.column(text_col)))
                out = rows(table, shard, find(shard, tests))
                yield from out.to_batches()
                del table, shard, out
                release()

        return docs.mapInArrow(direct, schema)

    blocks = stored_by_block(pack(docs, text_col, SHARD_BYTES), "train")
    chunks = stored(pack(items, item_text, chunk_bytes), "chunks")

    def search(batches):
        held, tests = None, None
        for batch in batches:
            for chunk, tested, block, packed in zip(*(batch.column(c).to_pylist() for c in ("chunk", "tested", "block", "packed"))):
                if chunk != held:  # pairs come chunk by chunk, so a task prepares a chunk once
                    held, tests = chunk, Tests(read_table(tested), window)
                yield find(Shard(texts_of(read_table(packed).column(text_col))), tests).packed(block)
                release()

    # every chunk against every block, not item against document: tasks read both from the shared folder, in one job
    pairs = chunks.select(F.col("block").alias("chunk"), F.col("packed").alias("tested")).hint("shuffle_replicate_nl").crossJoin(blocks.select("block", "packed"))
    found = stored(pairs.mapInArrow(search, FOUND), "matches")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        table = read_table(left.column("packed")[0].as_py())
        return rows(table, Shard(texts_of(table.column(text_col))), Found.joined(right.to_pylist()))

    return blocks.select("block", "packed").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, schema)


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 10, chunk_bytes: int = CHUNK_BYTES, with_ids: bool = True) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated, and (``with_ids``) item_ids, sorted as strings."""
    docs = pick(docs, **{id_col: "long", text_col: "string"})
    schema = f"{id_col} long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean" + ", item_ids array<string>" * with_ids
    return _searched(docs, items, text_col, item_id, item_text, window, chunk_bytes, lambda t, s, f: _summary(t, s, f, id_col, with_ids), schema)


def verbatim_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                     item_text: str = "text", window: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Longest verbatim matches: id, item_ids (those with that text), doc_word (place in the document), n_words."""
    docs = pick(docs, **{id_col: "long", text_col: "string"})

    def rows(table, shard, found) -> pa.Table:
        ids, row = table.column(id_col).to_pylist(), shard.row[found.word]
        return pa.table({id_col: pa.array([ids[r] for r in row.tolist()], pa.int64()), "item_ids": pa.array([found.owners[o] for o in found.owner.tolist()], pa.list_(pa.string())),
                         "doc_word": pa.array(found.word - shard.spans.first[row], pa.int64()), "n_words": pa.array(found.size, pa.int64())})

    return _searched(docs, items, text_col, item_id, item_text, window, chunk_bytes, rows, f"{id_col} long, item_ids array<string>, doc_word long, n_words long", _longest)


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                        window: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` with all columns, without the documents that hold a test window."""
    place = f"c{replace_column(docs.columns, text_col)}"
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def rows(table, shard, found) -> pa.Table:
        bad = set(shard.row[found.word].tolist())
        return table.filter(pa.array([t not in bad for t in range(table.num_rows)], pa.bool_()))

    return _searched(plain, items, place, item_id, item_text, window, chunk_bytes, rows, plain.schema).toDF(*docs.columns)
