"""Every numbered query at the smallest scale: the columns agreed on, and its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import norm
from fleetmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_block_labeller": "page_id bigint, url string, text string, n_chars bigint",
    "op2_url_rules": "page_id bigint, host string, path string, rule string, verdict string",
    "op3_language_ppm": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_conflict_packing": "doc_id bigint, bin_id bigint",
    "op5_pitman_yor": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op6_source_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_polytope_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op8_minmax_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op9_multi_index": "query_id bigint, rank int, vec_id bigint, score double",
    "op10_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op11_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op12_phrase_mining": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op13_feast_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
}


def test_all_are_registered():
    assert list(QUERIES) == list(COLUMNS) and set(QUERIES) < set(entry_points.queries()) and "pipeline" in entry_points.queries()
    assert set(ORACLES) < set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_sql(spark, name):
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split()
        assert kinds[column] == kind, column
    rows = df.collect()
    assert rows
    if name in ORACLES:
        con = duckdb.connect()
        for table in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        cur = con.execute(ORACLES[name])
        cols = [c[0] for c in cur.description]
        assert sorted(cols) == sorted(df.columns)
        order = sorted(cols)
        assert sorted((tuple(norm(r[c]) for c in order) for r in rows), key=str) == sorted((tuple(norm(r[cols.index(c)]) for c in order) for r in cur.fetchall()), key=str)
