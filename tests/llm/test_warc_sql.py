"""The archive query against SQL; it has no registered SQL, as integers that may be null compare by type there."""

import duckdb

from logflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex,
        min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
      array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
      CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM d
"""


def test_warc_query_matches_sql(spark):
    got = QUERIES["op1_warc"](spark, SF_DIR)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'")
    want = con.execute(SQL)
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
