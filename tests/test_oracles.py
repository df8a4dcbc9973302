"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SF_SMALL
from eventloom.plans import registry

# the training-data queries have tests of their own
ORACLES = {n: sql for n, sql in E.oracle_sql().items() if n in registry.QUERIES}
NO_ORACLE = sorted(set(registry.QUERIES) - set(ORACLES))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    r = compare(df, con_small, ORACLES[name])
    assert r["cols_match"], r["cols"]
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash_match"], r["diff"]


@pytest.mark.parametrize("name", NO_ORACLE)
def test_query_without_oracle_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer", "score", "email", "birthYear"]
    assert df.count() > 0


def test_every_survey_operator_registered():
    expected = set("""src_topic src_topic_pattern src_offsets src_bounded_batch src_text src_text_stream
    src_incremental src_csv_schema sink_topic sink_topic_raw sink_keyed_send sink_console sink_csv
    sink_foreach dec_strings dec_json dec_envelope dec_base64 dec_two_level enc_json dec_rejects
    dec_demux sel_star sel_rename sel_sanitize flt_ge flt_like_and flt_notnull flt_contains
    fn_upper_substr fn_split_item fn_slug fn_status_text fn_train_id fn_line_case fn_json_get
    fn_letter_count udf_processor join_ss_deposits join_ss_withdrawals join_ss_checkin join_ss_risk
    join_ss_location join_travel join_st_left join_st_inner join_full join_rejects agg_sum_key
    agg_basic agg_count_station agg_histogram agg_topk win_tumbling win_hopping win_assign
    win_hopping_keys win_session win_topk win_current win_late win_tumbling_stream
    win_hopping_stream win_session_stream tbl_latest tbl_compact tbl_filtered
    tbl_station_transform tbl_train_position tbl_latest_global tbl_route_by_topic tbl_status_board
    cat_declare cat_derive cat_drop""".split())
    assert expected <= set(E.queries())
