"""Every stage of the pipeline against a plain version on its own input, and the chain as a whole."""

from tests.conftest import SF0001
from tests.llm.test_decontaminate import plain as plain_contamination
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substring_dedup import plain as plain_repeats
from tokenizers import Tokenizer

import corpus_pipeline as P
from candela.llm import toxicity
from candela.llm.common import stored
from candela.llm.queries import TOKENIZER, toxicity_fold


def test_stages(spark, corpus, tmp_path):
    own = spark.read.parquet(f"{SF0001}/documents.parquet")
    offset = 1 + own.agg({"doc_id": "max"}).first()[0]
    extra = spark.createDataFrame([(None if i is None else i + offset + 1000, t, None, "src", None if t is None else len(t)) for i, t in corpus], own.schema)
    d = str(tmp_path)
    own.unionByName(extra).write.parquet(f"{d}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF0001}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    docs, inputs, outputs = spark.read.parquet(f"{d}/documents.parquet"), {}, {}
    for name, stage in P.STAGES:
        inputs[name] = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        before, docs = docs, stored(stage(spark, docs, d), "test")
        if name != P.STAGES[-1][0]:
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            outputs[name] = [(r.doc_id, r.text) for r in docs.collect()]

    weights = toxicity.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"), learn=toxicity_fold)
    s = toxicity.text_scores(weights, [(t or "").encode() for _, t in inputs["toxicity"]])
    assert sorted(outputs["toxicity"], key=repr) == sorted((x for x, y in zip(inputs["toxicity"], s) if y < 0.3), key=repr)

    rows = inputs["simhash_near_dedup"]
    group, best = plain_components([plain_fingerprint(t) for _, t in rows], 2), {}
    for x, (i, _) in enumerate(rows):
        best.setdefault(group[x], []).append((i is None, i or 0))
    assert sorted((i is None, i or 0) for i, _ in outputs["simhash_near_dedup"]) == sorted(map(min, best.values()))

    rows = inputs["substring_dedup"]
    want = [(i, text if n else t) for (i, t), (_, _, n, text, _) in zip(rows, plain_repeats(rows, 13))]
    assert sorted(outputs["substring_dedup"], key=repr) == sorted(want, key=repr)

    rows = inputs["benchmark_decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    found = plain_contamination(rows, items, 10)
    assert sorted((i for i, _ in outputs["benchmark_decontamination"]), key=repr) == sorted((r[0] for r in found if not r[-1]), key=repr)

    t, last = Tokenizer.from_file(TOKENIZER), inputs["bpe"]
    got = sorted(((r.doc_id, r.ids, r.n_tokens) for r in docs.collect()), key=repr)
    want = [(i, ids := t.encode(x or "", add_special_tokens=False).ids, len(ids)) for i, x in last]
    assert got == sorted(want, key=repr)
    assert P.run(spark, d).count() == len(want)
