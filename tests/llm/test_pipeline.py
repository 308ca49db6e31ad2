"""The pipeline stage by stage: each against a brute-force version on its own input."""

from __future__ import annotations

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sheaf.llm import queries, secret_scan
from sheaf.llm.common import materialise, read, tokenizer_path
from tests.llm.test_joins import contaminated, linked, measures, print_of

SF = "/root/testdata/sf0.001"


def rows_of(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns, stages, before = docs.columns, dict(corpus_pipeline.STAGES), rows_of(docs)
    results = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns and all(r.n_chars == len(r.text) for r in docs.collect())
        results[name] = (before, rows_of(docs))
        before = results[name][1]

    had, kept = results["quality_rules"]
    failed = {d for d, t in had.items() if measures(t)[0] < 10 or 100 * measures(t)[4] > 20 * measures(t)[0]}
    assert not failed & kept.keys()  # and a line of a kept text is one of its document's lines
    assert all(set(t.split("\n")) <= set(had[d].split("\n")) for d, t in kept.items())

    had, kept = results["near_duplicates"]
    prints = {d: print_of(t) for d, t in had.items()}
    roots = linked(set(prints.values()), 2)
    least = {}
    for d, p in prints.items():
        least[roots[p]] = min(d, least.get(roots[p], d))
    assert kept == {d: had[d] for d in least.values()}

    had, kept = results["decontamination"]
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    bad = {r[0] for r in contaminated(list(had.items()), items) if r[-1]}
    assert bad and kept == {d: t for d, t in had.items() if d not in bad}

    had, kept = results["secrets"]
    planted = re.compile(r"AKIA[0-9A-Z]{16}|token = \"[0-9a-f]{40}\"")
    assert kept.keys() == had.keys()
    assert {d for d in had if kept[d] != had[d]} >= {d for d, t in had.items() if planted.search(t)}
    for d, text in kept.items():
        parts = text.split(secret_scan.MARK)
        assert re.fullmatch(".*?".join(map(re.escape, parts)), had[d], re.S)
        assert not planted.search(text)

    tokens = {r.doc_id: list(r.ids) for r in stages["tokens"](spark, docs, SF).collect()}
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    assert tokens == {d: library.encode(t, add_special_tokens=False).ids for d, t in kept.items()}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == ["doc_id", "ids"] and {r.doc_id: list(r.ids) for r in whole.collect()} == tokens


#: Queries that return something other than a row for each document or page.
OTHERS = {"op8_secret_scan", "op11_source_divergence", "op12_collocations"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_whole_tables(spark, name):
    rows = queries.QUERIES[name](spark, SF).count()
    table = "pages" if name == "op3_warc_index" else "documents"
    assert rows > 0 if name in OTHERS else rows == read(spark, SF, table).count()
