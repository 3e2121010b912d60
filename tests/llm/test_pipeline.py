"""The whole pipeline against its stages in plain code, and on odd rows."""

from collections import defaultdict

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from namewake.llm.common import save
from namewake.llm.words_bpe import library, tokenizer_path
from tests.llm.odd import no_docs, odd_docs, words_of
from tests.llm.test_jaccard_join import plain_components
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality_rules import plain_stats

SF = "/root/testdata/sf0.001"


def test_stages_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = save(stage(spark, docs, SF), name)
        assert out.schema == docs.schema
        docs = out
        rows.append({r.doc_id: r for r in docs.collect()})
    raw, good, single, private = rows

    def fails(text):
        n, _, _, _, repeated = plain_stats(text)
        return n < 50 or 100 * repeated > 50 * n

    assert good.keys() == {i for i, r in raw.items() if not fails(r.text)}  # no line is above a limit here
    comps = plain_components({i: r.text for i, r in good.items()})
    assert single.keys() == {i for i, (_, c) in comps.items() if c == i}
    assert private.keys() == single.keys()
    assert all(r.n_chars == len(r.text) for r in private.values())

    mixed = save(corpus_pipeline.mix(spark, docs, SF), "mixed")
    sizes, words = defaultdict(int), defaultdict(int)
    for r in private.values():
        sizes[r.source] += len(words_of(r.text))
    for r in mixed.collect():
        words[r.source] += len(words_of(r.text))
    assert dict(words) == {s: round(t) for s, t in plain_targets(sizes).items()}

    coded = corpus_pipeline.encode(spark, mixed, SF).collect()
    texts = sorted((r.doc_id, r.text) for r in mixed.collect())
    ids = [e.ids for e in library(tokenizer_path()).encode_batch([t for _, t in texts], add_special_tokens=False)]
    want = sorted((i, tuple(x)) for (i, _), x in zip(texts, ids))
    assert sorted((r.doc_id, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in coded) == want


def test_run_gives_what_the_stages_give(spark):
    got = entry.queries()["pipeline"](spark, SF)
    assert {"doc_id", "n_tokens", "ids"} <= set(got.columns)
    assert got.count() > 100


def test_stages_on_odd_and_on_no_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = save(stage(spark, docs, ""), name)


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
