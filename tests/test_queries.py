"""Every registered query of the history operators against its SQL oracle."""

import duckdb
import pytest

from chronofold.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert plain(df.select(*columns).collect()) == plain([[r[names.index(c)] for c in columns] for r in found.fetchall()])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_q47_is_the_operator(spark, monkeypatch, con):
    """The query hands the history of every customer to successors()."""
    from chronofold.plans import queries

    calls, operator = [], queries.successors.successors
    monkeypatch.setattr(queries.successors, "successors", lambda h: calls.append(h) or operator(h))
    QUERIES["q47_successors"](spark, SF)
    assert len(calls) == 1 and calls[0].select("code").distinct().count() == con.execute("SELECT count(DISTINCT o_custkey) FROM orders").fetchone()[0]


def test_q48_asks_for_all_parts(spark, con):
    found = {r["category"] for r in QUERIES["q48_category_candidates"](spark, SF).select("category").collect()}
    expected = {r[0] for r in con.execute("SELECT DISTINCT lpad(CAST(p_size % 50 AS VARCHAR), 3, '0') || ' ' || p_name FROM part").fetchall()}
    assert found == expected


def on_tables(spark, tmp_path, name, **tables):
    """Rows of a query and of its SQL over small tables, by column name."""
    c = duckdb.connect()
    for table, sql in tables.items():
        c.execute(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    df, found = QUERIES[name](spark, str(tmp_path)), c.execute(ORACLE_SQL[name])
    columns, names = sorted(df.columns), [d[0] for d in found.description]
    return plain(df.select(*columns).collect()), plain([[r[names.index(x)] for x in columns] for r in found.fetchall()])


def test_q28_numbers_longer_than_their_code(spark, tmp_path):
    """From key 12,628 on the number has nine digits, of which a code of eight keeps the first ones."""
    got, expected = on_tables(spark, tmp_path, "q28_gtin_check", part="SELECT range AS p_partkey FROM range(12500, 14000)")
    assert got == expected and len(got) == 1500


PARTS = "SELECT {key} AS p_partkey, CASE WHEN range % 11 = 0 THEN NULL ELSE 'B' || range % 2 END AS p_brand, CASE WHEN range % 13 = 0 THEN NULL ELSE 900.5 + range % 300 END AS p_retailprice FROM range({n})"


def fails_on_all_pairs(monkeypatch):
    from chronofold.functions import text

    def refuse(a, b):
        raise AssertionError("compares all pairs of a block")

    monkeypatch.setattr(text, "hamming_one", refuse)


@pytest.mark.parametrize("key", ["range", "nullif(range % 40, 3)"])
def test_q27_without_all_pairs(spark, tmp_path, monkeypatch, key):
    """Keys at one place and at several, missing ones too."""
    fails_on_all_pairs(monkeypatch)
    got, expected = on_tables(spark, tmp_path, "q27_hamming_one", part=PARTS.format(key=key, n=700))
    assert got == expected and len(got) >= 40


@pytest.mark.parametrize("key", ["range", "range % 900"])
def test_q59_without_all_pairs(spark, tmp_path, monkeypatch, key):
    fails_on_all_pairs(monkeypatch)
    got, expected = on_tables(spark, tmp_path, "q59_one_digit_prices", part=PARTS.format(key=key, n=1500).replace("range % 2", "range % 40"))
    assert got == expected and len(got) > 20
