"""Whole-table migrations on the test tables: persons and their id map, sentences, habits, handover headers and their links."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from farelane.operators.migration_graph import Code, CodeList, Graph, KeyMap, Link, Step, Through
from farelane.session import scratch_path
from farelane.sources.testtables import read_table

RUN_AT = datetime(2024, 6, 1, 12, 0, 0)

PERSONS = Step(
    "person", "old_person", {"file": "file_text", "segment": "segment"}, prepared=lambda old: old.filter("balance >= 0"), id_column="id",
    makes={"person_map": KeyMap("old_person", "person", "pn_id", "id", "file_text", "file", as_text=True)},
)
SENTENCES = Step(
    "sentence", "old_sentence", {n: n for n in ("case_no", "person_id", "court_id", "place_id", "crimes_ids", "status")} | {"searched": "1"},
    through=[Through("person_map", "pn_id", "person_id", "left")],
    codes=[Code("court", "offices", "court_id", live_only=True), Code("place", "offices", "place_id", as_text=True)],
    lists=[CodeList("crimes", "offices", "crimes_ids")],
)
HABITS = Step(
    "habit", "old_habit",
    {n: n for n in ("line_no", "part_no", "person_id", "reason_id", "kind_id")} | {"substances": "concat('[', coalesce(cast(substance_id as string), ''), ']')"},
    through=[Through("person_map", "pn_id", "person_id")],
    codes=[Code("substance", "offices", "substance_id"), Code("reason", "offices", "reason_id", live_only=True), Code("kind", "kinds", "kind_id")],
)
OFFICE = Code("office", "offices", "office_id")
HEADERS = Step("header", "old_handover", {n: n for n in ("giver", "rank", "office_id")}, codes=[OFFICE], distinct=True, id_column="id", audit=False)
LINKS = Step(
    "header_person", "old_handover", {n: n for n in ("record_no", "line_no", "header_id", "person_id")}, codes=[OFFICE],
    through=[Through("person_map", "pn_id", "person_id")],
    links=[Link("header", {"giver": "giver"}, {"rank": "rank", "office_id": "office_id"}, "header_id")],
)
# In no particular order: the graph finds it.
GRAPH = Graph((LINKS, SENTENCES, HABITS, HEADERS, PERSONS))


def legacy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The legacy tables and dictionaries."""
    customer, orders, lines, nation = (read_table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "nation"))
    return {
        "old_person": customer.selectExpr("c_custkey AS pn_id", "concat(' ', c_name, ' ') AS file_text", "c_mktsegment AS segment", "c_acctbal AS balance"),
        "old_sentence": orders.selectExpr(
            "o_orderkey AS case_no", "o_custkey AS pn_id", "cast(o_custkey % 27 AS string) AS court", "concat(' ', o_orderkey % 25) AS place",
            "concat(o_custkey % 25, ',', o_orderkey % 30, ';', o_orderkey % 7) AS crimes", "o_orderstatus AS status",
        ),
        "old_habit": lines.selectExpr(
            "l_orderkey AS line_no", "l_partkey AS part_no", "l_suppkey AS pn_id", "cast(l_partkey % 30 AS string) AS substance",
            "cast(l_linenumber AS string) AS reason", "l_returnflag AS kind",
        ),
        "old_handover": lines.selectExpr(
            "l_orderkey AS record_no", "l_linenumber AS line_no", "l_suppkey AS pn_id", "CASE WHEN l_orderkey % 5 <> 0 THEN concat('G', l_suppkey % 20) END AS giver",
            "CASE WHEN l_linenumber % 3 <> 0 THEN concat('R', l_linenumber % 3) END AS rank", "cast(l_partkey % 28 AS string) AS office",
        ),
        "offices": nation.selectExpr("cast(n_nationkey AS string) AS code", "n_nationkey + 500L AS id", "CASE WHEN n_nationkey % 6 = 0 THEN 1 ELSE 0 END AS is_deleted"),
        "kinds": lines.selectExpr("l_returnflag AS code").distinct().selectExpr("code", "ascii(code) AS id"),
    }


def migrated(target: str) -> Callable[[SparkSession, str], DataFrame]:
    """One target of the graph, without its audit columns; ids that are NULL are shown as -1."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = GRAPH.run(spark, legacy(spark, sf_dir), scratch_path(spark, "migration"), RUN_AT)
        step = next(s for s in GRAPH.steps if s.target == target)
        return made[target].select(*([step.id_column] if step.id_column else []), *step.columns).fillna(-1)

    return query


def migration_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per target."""
    return {f"migrate_{s.target}": migrated(s.target) for s in GRAPH.steps}


PERSON_SQL = """
    person AS (SELECT row_number() OVER (ORDER BY c_name, c_mktsegment) AS id, c_custkey AS pn_id, ' ' || c_name || ' ' AS file, c_mktsegment AS segment
               FROM customer WHERE c_acctbal >= 0),
    offices AS (SELECT n_nationkey AS code, CAST(n_nationkey + 500 AS BIGINT) AS id, n_nationkey % 6 = 0 AS gone FROM nation)"""
HANDOVER_SQL = f"""{PERSON_SQL},
    handover AS (SELECT l_orderkey AS record_no, l_linenumber AS line_no, l_suppkey AS pn_id, CASE WHEN l_orderkey % 5 <> 0 THEN 'G' || (l_suppkey % 20) END AS giver,
                        CASE WHEN l_linenumber % 3 <> 0 THEN 'R' || (l_linenumber % 3) END AS rank, o.id AS office_id
                 FROM lineitem LEFT JOIN offices o ON o.code = l_partkey % 28),
    header AS (SELECT row_number() OVER (ORDER BY giver NULLS FIRST, rank NULLS FIRST, office_id NULLS FIRST) AS id, * FROM (SELECT DISTINCT giver, rank, office_id FROM handover))"""


def migration_sql() -> dict[str, str]:
    """Independent SQL per target."""
    crimes = " UNION ALL ".join(
        f"SELECT o_orderkey, {k} AS pos, id FROM orders JOIN offices ON code = {e}" for k, e in enumerate(("o_custkey % 25", "o_orderkey % 30", "o_orderkey % 7"))
    )
    return {
        "migrate_person": f"WITH {PERSON_SQL} SELECT id, file, segment FROM person",
        "migrate_sentence": f"""WITH {PERSON_SQL}, crimes AS (SELECT o_orderkey, string_agg(id, ',' ORDER BY pos) AS ids FROM ({crimes}) GROUP BY o_orderkey)
            SELECT o.o_orderkey AS case_no, coalesce(p.id, -1) AS person_id, coalesce(c.id, -1) AS court_id, coalesce(l.id, -1) AS place_id, '[' || coalesce(ids, '') || ']' AS crimes_ids,
                   o_orderstatus AS status, 1 AS searched
            FROM orders o LEFT JOIN person p ON p.pn_id = o_custkey LEFT JOIN offices c ON c.code = o_custkey % 27 AND NOT c.gone
            LEFT JOIN offices l ON l.code = o.o_orderkey % 25 LEFT JOIN crimes x ON x.o_orderkey = o.o_orderkey""",
        "migrate_habit": f"""WITH {PERSON_SQL}
            SELECT l_orderkey AS line_no, l_partkey AS part_no, p.id AS person_id, coalesce(r.id, -1) AS reason_id, CAST(ascii(l_returnflag) AS INTEGER) AS kind_id,
                   '[' || coalesce(CAST(s.id AS VARCHAR), '') || ']' AS substances
            FROM lineitem JOIN person p ON p.pn_id = l_suppkey LEFT JOIN offices s ON s.code = l_partkey % 30
            LEFT JOIN offices r ON r.code = l_linenumber AND NOT r.gone""",
        "migrate_header": f"WITH {HANDOVER_SQL} SELECT id, giver, rank, coalesce(office_id, -1) AS office_id FROM header",
        "migrate_header_person": f"""WITH {HANDOVER_SQL}
            SELECT record_no, line_no, h.id AS header_id, p.id AS person_id FROM handover r JOIN person p ON p.pn_id = r.pn_id
            JOIN header h ON h.giver = r.giver AND h.rank IS NOT DISTINCT FROM r.rank AND h.office_id IS NOT DISTINCT FROM r.office_id""",
    }
