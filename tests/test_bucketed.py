from datetime import date

import pytest

from closebook.operators import views
from closebook.operators.skew import SALT
from closebook.plans.books import Books
from closebook.plans.bucketed import BucketedBooks
from closebook.session import materialise
from tests import samples

MONTHS = [date(2025, m, 28) for m in (1, 2, 3, 5)]


def given(spark):
    """Clients with one row on the last date of a month, and one client with many in some months."""
    positions = [samples.position(f"P{c}{a}{k}", day, quantity=k + 1, client=c, asset=a) for c in ("C1", "C2") for a in ("ETH", "BTC") for k, day in enumerate(MONTHS)]
    positions += [samples.position(f"T{k}", MONTHS[1], quantity=k + 9, ref=f"R{k}") for k in range(6)]
    positions += [samples.position(f"U{k}", MONTHS[2], quantity=k + 20, ref=f"R{k}", client="C2") for k in range(3)]
    return samples.tables(
        spark,
        positions=positions,
        rewards=[samples.reward(f"W{c}{k}", day, 3 + k, client=c) for c in ("C1", "C2") for k, day in enumerate(MONTHS)],
        fees=[samples.fee(f"F{c}{k}", day.replace(day=1), client=c, invoice=f"I{k}") for c in ("C1", "C2") for k, day in enumerate(MONTHS)],
        events=[samples.event(f"E{c}{k}", day.replace(day=1), client=c) for c in ("C1", "C2") for k, day in enumerate(MONTHS)],
        clients=[samples.client("C1"), samples.client("C2")],
    )


def compared(df):
    moments = ("StatementGeneratedAt", "ReconciliationRunAt", "ReconRunAt", "_BuiltAt")
    names = [c for c in sorted(df.columns) if c not in moments]
    return names, sorted(str(tuple(r)) for r in df.select(*names).collect())


@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
def test_bucketed_books_equal_lazy_ones(spark, tmp_path, hot_rows):
    tables = given(spark)
    plain = Books(tables)
    for again in range(2):  # the second time the tables are replaced
        books = BucketedBooks(tables, f"equal_{hot_rows}", 3, f"{tmp_path}/books", keep=materialise, hot_rows=hot_rows)
        names = ("monthly_statement",) if again else ("balances", "staking_rewards", "client_positions", "reconciliation", "tie_out", "monthly_statement")
        for name in names:
            found = compared(getattr(books, name))
            assert found[1] and found == compared(getattr(plain, name)), name
    assert spark.table(f"equal_{hot_rows}_client_positions").inputFiles()[0].startswith(f"file://{tmp_path}/books/client_positions")


def test_a_period_reads_its_own_rows(spark, tmp_path):
    tables = given(spark)
    options = {"keep": materialise, "period": date(2025, 3, 1)}
    found = compared(BucketedBooks(tables, "one_month", 2, f"{tmp_path}/books", **options).monthly_statement)
    assert found[1] and found == compared(Books(tables, **options).monthly_statement)


def test_a_watch_is_refused(spark):
    from closebook.operators.gate import Watch

    with pytest.raises(ValueError, match="watched"):
        BucketedBooks(given(spark), "watched", 2, watch=Watch())


def shuffles(df):
    query = df._jdf.queryExecution()
    query.toRdd().count()
    plan = query.executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]


def test_only_salted_rows_are_exchanged(spark, tmp_path):
    """Not by broadcasts of small tables, which are switched off here."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        books = BucketedBooks(given(spark), "exchanged", 4, f"{tmp_path}/books", keep=materialise, hot_rows=3)
        for result in (books.monthly_statement, books._salted_reconciliation):
            found = shuffles(result)
            assert len(found) == 2 and all(SALT in line for line in found)
        ordinary, _ = books._balances
        spine = views.client_positions(ordinary, books.tables.Customers, books.tables.ReferenceAssets, books.staking_rewards, books._fee_sums)
        assert not [line for line in shuffles(spine) if "AssetId" in line and "CustomerId" in line]
        salted = views.client_positions(books._balances[1], books.tables.Customers, books.tables.ReferenceAssets, books.staking_rewards, books._fee_sums, hot=books.hot, keep_salt=True)
        assert all(SALT in line for line in shuffles(salted) if "AssetId" in line and "CustomerId" in line)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_clients_without_very_many_rows_make_the_buckets(spark, tmp_path):
    """Every row is dealt once, when it is read; no result of the tables exchanges one."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        tables = given(spark)
        books = BucketedBooks(tables, "by_client", 4, f"{tmp_path}/books", keep=materialise)
        assert books.even and not shuffles(books.monthly_statement) and not shuffles(books._salted_reconciliation)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    for name in ("balances", "staking_rewards", "client_positions", "reconciliation", "tie_out", "monthly_statement"):
        assert compared(getattr(books, name)) == compared(getattr(Books(tables, hot_rows=3), name)), name


@pytest.mark.parametrize("hot_rows", [1, 3])
def test_hot_keys_of_clients_without_very_many_rows_lie_in_buckets_of_clients(spark, tmp_path, monkeypatch, hot_rows):
    from closebook.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", -1)  # else so small a table is salted as a whole
    tables, prefix = given(spark), f"apart_{hot_rows}"
    books = BucketedBooks(tables, prefix, 3, f"{tmp_path}/books", keep=materialise, hot_rows=hot_rows)
    assert books.apart
    for name in ("balances", "client_positions", "reconciliation", "tie_out", "monthly_statement"):
        assert compared(getattr(books, name)) == compared(getattr(Books(tables), name)), name
    for name in ("balances", "client_positions", "staking_rewards", "prior_positions"):
        described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {prefix}_{name}").collect()}
        assert described["Bucket Columns"] == "[`CustomerId`]"
    month = {"keep": materialise, "period": date(2025, 3, 1)}
    found = compared(BucketedBooks(tables, prefix, 2, f"{tmp_path}/month", hot_rows=hot_rows, **month).monthly_statement)
    assert found[1] and found == compared(Books(tables, **month).monthly_statement)
