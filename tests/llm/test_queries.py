"""The registered queries: names, SQL parity, columns of the contracts."""

import pytest
from llm_tables import SF01
from oracle_check import compare, duck

import __spark_entry__ as E
from sluice.llm import queries as Q

COLUMNS = {
    1: "doc_id:bigint held_out:boolean score:double predicted:int",
    3: "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    4: "page_id:bigint host:string path:string rule:string verdict:string",
    6: "query_id:bigint rank:int vec_id:bigint score:double",
    8: "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint "
       "base_failed:boolean kept:boolean",
    10: "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    11: "doc_id:bigint n_lines:bigint n_dropped:bigint kept_sha256:string",
    12: "doc_id:bigint n_features:bigint weight:bigint score:bigint rank:bigint",
    13: "doc_id:bigint leaf:string subroot:string root:string proof_sha256:string folded_root:string verified:boolean",
}


def named(n):
    return next(f for name, f in E.queries().items() if name.startswith(f"op{n}_"))


def test_all_are_registered():
    assert [k.split("_")[0] for k in Q.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_sql(spark, name):
    n, problems = compare(spark, duck(SF01), name, E.queries()[name], E.oracle_sql()[name], SF01)
    assert n and not problems, problems


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns(spark, n):
    assert " ".join(f"{c}:{t}" for c, t in named(n)(spark, SF01).dtypes[:9]) == COLUMNS[n]
