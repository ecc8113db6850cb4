"""Every query of the subpackage runs on the smallest tables with its columns."""

import os

import duckdb
import pytest

from millrace.llm import registry

from ..conftest import DATA

COLUMNS = {
    "p1_found": ["pair_a", "pair_b"],
    "p1_collapsed": ["pair_id", "n_copies"],
    "p3_found": ["rec_a", "rec_b"],
    "p3_classes": ["rec_id", "class_id", "n_links"],
    "p4_found": ["src_table", "row_id", "field", "turn", "defect"],
    "p4_summary": ["src_table", "field", "defect", "n_answers", "n_by_neighbour", "n_by_limit"],
    "p5_sequences": ["rec_id", "piece", "length", "sequence", "offset"],
    "p5_fill": ["n_sequences", "n_chars", "least_sequences", "mean_fill", "cost_spread"],
    "p5_invariants": ["n_records", "n_chars", "n_pieces", "n_divided", "n_overfull", "n_gaps", "n_unnumbered"],
    "p7_invariants": ["n_over_repeats", "n_unknown", "n_twice", "n_targets", "n_share_off"],
    "p6_found": ["doc_id", "item_id"],
    "p6_items": ["item_id", "n_verbatim", "n_paraphrased"],
    "p7_mix": ["doc_id", "source", "tokens", "repeats", "finish"],
    "p7_shares": ["source", "target_share", "max_repeats", "n_documents", "tokens", "share", "share_of_available"],
    "p8_found": ["doc_id", "kind"],
    "p8_clean": ["doc_id", "doc_type", "n_chars"],
}


def test_all_queries_are_listed():
    assert set(COLUMNS) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_runs(spark, name):
    out = registry.QUERIES[name](spark, DATA)
    assert out.columns == COLUMNS[name]
    rows = out.collect()
    assert len(rows) == len(set(rows))
    assert rows
    if name in registry.ORACLES:
        con = duckdb.connect()
        for file in os.listdir(DATA):
            con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
        want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({registry.ORACLES[name]})").fetchall()
        assert sorted(map(tuple, rows)) == sorted(want)
