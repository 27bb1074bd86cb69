"""Hot keys: same rows, spread over tasks, and no unchecked broadcast or cross join."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from closebook.operators import skew, views
from closebook.operators.skew import SALT, broadcast_if_small, hot_keys, spread
from tests.samples import books, client, event, fee, position, reward

MARCH, APRIL = date(2025, 3, 1), date(2025, 4, 1)
NAMES = ("client_positions", "reconciliation", "monthly_statement", "balances", "tie_out")


def crowded(spark, **options):
    """One client's ETH holds most rows, several on the last day of each month."""
    positions = [position(f"H{i}", date(2025, 3, 1 + i % 20), quantity=i) for i in range(60)]
    positions += [position(f"A{i}", date(2025, 4, 28 + i % 2), quantity=i) for i in range(20)]
    positions += [position(f"C{i}", date(2025, 3, 5 + i), client=f"C{i % 3}", asset="BTC") for i in range(9)]
    positions += [position("N", None), position("M", MARCH, CustomerId=None)]
    return books(
        spark,
        positions=positions,
        rewards=[reward(f"S{i}", MARCH, net=i) for i in range(5)],
        fees=[fee("F", MARCH, invoice="I"), fee("G", MARCH, kind="staking")],
        events=[event("E", APRIL, status="pending")],
        clients=[client("C0"), client("C1"), client("C2", kyc="PENDING")],
        **options,
    )


def content(df):
    stamps = [name for name in df.columns if name in ("_BuiltAt", "ReconRunAt", "ReconciliationRunAt", "StatementGeneratedAt")]
    return sorted(map(str, df.drop(*stamps).collect()))


def test_salted_results_equal_unsalted_ones(spark):
    plain, salted = crowded(spark), crowded(spark, hot_rows=3)
    assert plain.hot.count() == 0 and salted.hot.count() > 0
    for name in NAMES:
        rows = content(getattr(plain, name))
        assert rows and rows == content(getattr(salted, name)), name


def test_ties_fan_out_through_the_prior_month(spark):
    statement = crowded(spark, hot_rows=3).monthly_statement
    april = statement.filter((F.col("PositionPeriod") == F.lit(APRIL)) & (F.col("Symbol") == "ETH"))
    assert april.count() == 10 * 3  # ten rows on 29 April, three on 20 March
    assert april.select("StatementId").distinct().count() == 1


def test_rows_of_a_hot_key_are_spread(spark):
    df = spark.range(30_000).select(
        F.lit("C1").alias("CustomerId"), F.lit("A").alias("AssetId"), F.lit(MARCH).alias("PositionPeriod"),
        F.lit(MARCH).alias("PositionDate"), F.col("id").alias("ID"),
    )
    hot = hot_keys(df, views.KEYS, order="PositionDate", min_rows=1_000)
    kept = skew.latest_per_key(df, views.KEYS, "PositionDate", hot, by=["ID"])
    per_salt = [row["count"] for row in kept.groupBy(SALT).count().collect()]
    assert sum(per_salt) == 30_000 and len(per_salt) >= 30
    assert max(per_salt) < 2 * 1_000


def test_every_key_above_the_threshold_is_hot(spark):
    df = spark.range(300_000).select(F.col("id").alias("v"), (F.col("id") % 100_001).alias("k"))
    hot = hot_keys(df, ["k"], order="v", min_rows=1)
    assert hot.count() == 100_001 and {row[skew.FAN] for row in hot.limit(10).collect()} <= {2, 3}


def test_spread_repeats_only_hot_rows(spark):
    right = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    hot = spark.createDataFrame([("a", 3, 9)], f"k string, {skew.FAN} int, {skew.LATEST} int")
    rows = sorted((row.k or "", row.v, row[SALT]) for row in spread(right, hot, ["k"]).collect())
    assert rows == [("", 3, 0), ("a", 1, 0), ("a", 1, 1), ("a", 1, 2), ("b", 2, 0)]


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(1000)
    assert "ResolvedHint" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(df, limit=100)._jdf.queryExecution().analyzed().toString()


def test_salted_rows_need_their_hot_keys(spark):
    salted = crowded(spark, hot_rows=3)._salted_positions
    with pytest.raises(ValueError, match="hot keys"):
        skew.join_by_key(salted, salted, views.KEYS, None)


def executed(df):
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString().split("Initial Plan")[0]


def test_positions_are_shuffled_once_on_the_way_to_the_reconciliation(spark, tmp_path):
    from closebook.plans.books import Books
    from closebook.schemas import SCHEMAS, SemanticTables

    source = crowded(spark).tables
    for name in SCHEMAS:
        source[name].write.parquet(f"{tmp_path}/{name}")
    stored = SemanticTables(**{name: spark.read.parquet(f"{tmp_path}/{name}") for name in SCHEMAS})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(Books(stored, hot_rows=3).reconciliation)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("WindowGroupLimit") == 2  # before and after the one shuffle
    position_scans = [line for line in plan.splitlines() if "FileScan" in line and "PositionDate" in line]
    assert len(position_scans) == 2  # hot keys and balances; the other uses of the hot keys are shared
    assert "Reused" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(CustomerId" in line and SALT in line]
    assert len(exchanges) == 5  # balances, rewards, fees, event totals, invoices: no second shuffle of the spine
    assert "CreatedAt" not in "".join(position_scans)  # unused columns are not read


def test_adaptive_execution_splits_a_hot_client(spark, monkeypatch, tmp_path):
    """Without a broadcast of the clients, the join on the client is split by Spark itself."""
    balances = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id").cast("string"))).alias("CustomerId"),
        F.concat(F.lit("ASSET_"), F.col("id").cast("string")).alias("AssetId"),
        F.lit(MARCH).alias("PositionPeriod"), F.lit(MARCH).alias("PeriodEndDate"),
        *[F.lit(1).cast("decimal(18,2)").alias(name) for name in ("PeriodEndQuantity", "PeriodEndPriceUSD", "PeriodEndValuationUSD")],
        F.lit("R").alias("CustodianLedgerRef"),
    )
    clients = balances.select("CustomerId").distinct().withColumns(
        {name: F.lit("x") for name in ("CustomerName", "CustomerType", "Jurisdiction", "RiskTier", "KycStatus")}
    )
    clients.write.parquet(str(tmp_path / "clients"))
    clients = spark.read.parquet(str(tmp_path / "clients"))
    b = crowded(spark)
    monkeypatch.setattr(views, "broadcast_if_small", lambda df: df)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = views.client_positions(balances, clients, b.tables.ReferenceAssets, b.staking_rewards, b.fee_accruals)
        plan = executed(result)
        assert result.count() == 60_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    assert "skew=true" in plan


def test_rows_are_small_only_if_no_group_of_keys_is_large(spark):
    df = spark.range(200_000).select(F.when(F.col("id") < 100_000, "A").otherwise(F.col("id").cast("string")).alias("key"))
    assert skew.all_small(df, "key", 150_000) and not skew.all_small(df, "key", 90_000)
    assert not skew.all_small(df.limit(1), "key", 3)  # not worth a scan


def test_without_hot_keys_a_statement_reads_every_table_once(spark, tmp_path):
    from closebook.plans.books import Books
    from closebook.schemas import SCHEMAS, SemanticTables

    salted = crowded(spark, hot_rows=3)
    for name in SCHEMAS:
        salted.tables[name].write.parquet(f"{tmp_path}/{name}")
    stored = SemanticTables(**{name: spark.read.parquet(f"{tmp_path}/{name}") for name in SCHEMAS})
    even = Books(stored)
    assert even.even and not salted.even
    columns = [name for name in even.monthly_statement.columns if name != "StatementGeneratedAt"]
    plan = executed(even.monthly_statement)
    assert sum("FileScan" in line and "PositionDate" in line for line in plan.splitlines()) == 1
    assert SALT not in plan
    found, expected = (sorted(map(str, b.monthly_statement.select(*columns).collect())) for b in (even, salted))
    assert found == expected and len(found) > 10


def test_without_hot_keys_rows_are_dealt_by_client_once(spark, tmp_path):
    """Positions, rewards, fees and events (the few clients are broadcast); the spine is not exchanged for its joins, sums and windows."""
    from closebook.plans.books import Books
    from closebook.schemas import SCHEMAS, SemanticTables

    salted = crowded(spark, hot_rows=3)
    for name in SCHEMAS:
        salted.tables[name].write.parquet(f"{tmp_path}/{name}")
    stored = SemanticTables(**{name: spark.read.parquet(f"{tmp_path}/{name}") for name in SCHEMAS})
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        even = Books(stored)
        for result, tables in ((even._salted_reconciliation, 4), (even.monthly_statement, 3)):
            found = [line for line in executed(result).splitlines() if "Exchange hashpartitioning(CustomerId" in line]
            assert len(found) == tables and not [line for line in found if "AssetId" in line]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert content(even.reconciliation) == content(salted.reconciliation)


def test_clients_are_small_only_if_no_table_has_many_rows_of_one(spark):
    few, many = spark.range(10).selectExpr("'A' AS key"), spark.range(100_000).selectExpr("'A' AS key")
    assert skew.all_small([few, few], "key", 90_000) and not skew.all_small([few, many], "key", 90_000)


def test_lines_of_an_order_are_dealt_once(spark, tmp_path):
    from checks import fixture

    spark.range(20).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "1 AS l_linenumber", "1d AS l_quantity", "1d AS l_extendedprice", "0d AS l_discount",
        "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp'1998-01-01' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(20).selectExpr("id AS o_orderkey", "id AS o_custkey", "timestamp'1998-01-01' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = fixture._lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2 and lines.count() == 20  # line items and orders


def stored_crowd(spark, path, **options):
    """Books over the crowded tables as files."""
    from closebook.plans.books import Books
    from closebook.schemas import SCHEMAS, SemanticTables

    source = crowded(spark).tables
    for name in SCHEMAS:
        source[name].write.mode("overwrite").parquet(f"{path}/{name}")
    return Books(SemanticTables(**{name: spark.read.parquet(f"{path}/{name}") for name in SCHEMAS}), **options)


@pytest.fixture
def large(spark, monkeypatch):
    """Tables of any size are taken for large ones, and nothing is broadcast unless the library says so."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    for name in settings:
        spark.conf.set(name, "-1")
    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", -1)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def dealt_tables(plan):
    """How often rows of a table are dealt by client, and how often its positions are read."""
    lines = plan.splitlines()
    dealt = [line for line in lines if "+- Exchange hashpartitioning(CustomerId" in line and "REPARTITION_BY_COL" in line and SALT not in line]
    return len(dealt), sum("FileScan" in line and "PositionDate" in line for line in lines)


def test_a_statement_with_hot_keys_deals_every_table_once(spark, tmp_path, large):
    """Positions, rewards and fees; the hot keys, the month before and the salted rows are found among the same dealt rows."""
    books = stored_crowd(spark, tmp_path, hot_rows=3)
    plan = executed(books.monthly_statement)
    assert dealt_tables(plan) == (3, 1)
    assert [line for line in plan.splitlines() if "Exchange hashpartitioning(CustomerId" in line and SALT in line]
    assert content(books.monthly_statement) == content(crowded(spark).monthly_statement)


def test_a_reconciliation_with_hot_keys_deals_every_table_once(spark, tmp_path, large):
    """Positions, rewards, fees, events and invoice lists."""
    books = stored_crowd(spark, tmp_path, hot_rows=3)
    plan = executed(books.reconciliation)
    assert dealt_tables(plan) == (5, 1)
    assert len([line for line in plan.splitlines() if "+- Exchange hashpartitioning(CustomerId" in line and SALT in line]) == 5
    assert content(books.reconciliation) == content(crowded(spark).reconciliation)


@pytest.mark.parametrize("hot_rows", [1, 3])
def test_results_with_hot_keys_apart_equal_unsalted_ones(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", -1)
    plain, apart = crowded(spark), crowded(spark, hot_rows=hot_rows)
    assert apart.apart and not apart.even and not plain.apart
    assert content(apart.hot) == content(views.hot_position_keys(plain.wide("CustodyPositions"), min_rows=hot_rows).select(*apart.hot.columns))
    for name in NAMES:
        assert getattr(apart, name).columns == getattr(plain, name).columns
        assert content(getattr(apart, name)) == content(getattr(plain, name)), name


def test_all_rows_are_salted_where_a_client_is_large_or_the_table_small(spark, tmp_path, monkeypatch):
    assert not stored_crowd(spark, tmp_path, hot_rows=3).apart
    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)  # the client has 80 positions
    monkeypatch.setattr(skew, "GROUPS", 40)
    assert not crowded(spark, hot_rows=3).apart
    monkeypatch.setattr(skew, "HOT_ROWS", 500)
    assert crowded(spark, hot_rows=3).apart


def test_tasks_follow_the_rows_not_the_shuffle_partitions(spark, tmp_path, large, monkeypatch):
    """With few shuffle partitions for its rows a task would sort and add up more than its memory holds, and spill."""
    monkeypatch.setattr(skew, "TASK_ROWS", 10)
    books = stored_crowd(spark, tmp_path, hot_rows=3)
    tasks = -(-books._rows_apart // 10)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = executed(books.reconciliation)
    dealt = [line for line in plan.splitlines() if "+- Exchange hashpartitioning(CustomerId" in line and "REPARTITION_BY" in line and SALT not in line]
    assert len(dealt) == 5 and all(f", {tasks})," in line and "REPARTITION_BY_NUM" in line for line in dealt)
    for name in ("reconciliation", "monthly_statement"):
        assert content(getattr(books, name)) == content(getattr(crowded(spark), name)), name


def test_a_reconciliation_with_hot_keys_deals_invoices_by_client_alone(spark, tmp_path, large):
    plan = executed(stored_crowd(spark, tmp_path, hot_rows=3).reconciliation)
    assert "rangepartitioning" not in plan
    assert "FeeType" not in "".join(line.split("hashpartitioning(")[1].split("), ")[0] for line in plan.splitlines() if "+- Exchange hashpartitioning(" in line)


def test_rows_are_counted_where_all_are_small(spark):
    few, many = spark.range(10).selectExpr("'A' AS key"), spark.range(100_000).selectExpr("'A' AS key")
    assert skew.rows_if_small([few, many], "key", 100_000) == 10 and skew.rows_if_small([many, few], "key", 100_000) == 100_000
    assert skew.rows_if_small([few, many], "key", 90_000) is None
    assert skew.rows_if_small([few.limit(0)], "key", 90_000) == 0
    assert skew.rows_if_small([few], "key", 3) is None  # not worth a scan


def test_invoices_are_not_dealt_by_client_where_one_has_very_many(spark, monkeypatch):
    from closebook.plans.books import Books
    from closebook.schemas import SCHEMAS, SemanticTables

    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(skew, "GROUPS", 40)
    source = crowded(spark).tables
    assert Books(source, hot_rows=3).apart
    named = {name: source[name] for name in SCHEMAS}
    many = named["FeeEvents"].crossJoin(spark.range(150).toDF("n")).withColumn("ID", F.concat("ID", F.col("n").cast("string"))).select(named["FeeEvents"].columns)
    crowd = SemanticTables(**(named | {"FeeEvents": many}))
    assert not Books(crowd, hot_rows=3).apart


def test_among_keeps_only_rows_of_hot_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, None), ("a", 2, "y"), (None, 1, "z")], "c string, month int, v string")
    hot = spark.createDataFrame([("a", 1, 3, 9)], f"CustomerId string, PositionPeriod int, {skew.FAN} int, {skew.LATEST} int")
    kept = skew.among(df, hot, ("c", "month"))
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == [("a", 1, "x"), ("a", 1, None)]
    assert skew.among(df, None, ("c", "month")) is df
