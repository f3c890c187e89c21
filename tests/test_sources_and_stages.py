import os

import pytest
from pyspark.sql import functions as F

from tallywright.checks.registry import raw_tables
from tallywright.plans.stages import Stages, from_files
from tallywright.schemas import RAW_COLUMNS
from tallywright.session import shared_folder
from tallywright.sources import tables
from tallywright.sources.tables import load_raw, rank_files, read_raw, table_counts, with_src_row, write_table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    raw = raw_tables(spark, FOLDER)["payment_gateway"]
    path = write_table(raw, str(tmp_path / "p"), "csv")
    again = read_raw(spark, path, "payment_gateway")
    assert raw.exceptAll(again).count() == again.exceptAll(raw).count() == 0


CUSTOMER = RAW_COLUMNS["customer_master"]


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "i.csv").write_text(
        "customer_id,invoice_id,net_amount,discount,tax,invoice_amount,invoice_date\n"
        "CUST1,INV1,4,3,2,1,2026-01-02\n"
    )
    raw = read_raw(spark, str(tmp_path / "i.csv"), "invoice", ordered=False).drop("src_row")
    assert [tuple(r) for r in raw.collect()] == [("INV1", "CUST1", "2026-01-02", "1", "2", "3", "4")]


def test_wrong_headers_and_rows_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("invoice_id,customer_id\n1,2\n")
    with pytest.raises(ValueError, match="missing columns .*discount"):
        read_raw(spark, str(tmp_path / "a.csv"), "invoice", ordered=False)
    head = ",".join(CUSTOMER)
    (tmp_path / "b.csv").write_text(f"{head}\nC1,name,e,p\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_raw(spark, str(tmp_path / "b.csv"), "customer_master", ordered=False).collect()


def test_quoted_fields_keep_commas_quotes_and_line_breaks(spark, tmp_path):
    head = ",".join(CUSTOMER)
    row = 'C1,"Al ""Ace"", Ltd",a@b.c,1,"12 A\nRoad",X,Y,Z,2026-01-01'
    (tmp_path / "c.csv").write_text(f"{head}\n{row}\n")
    path = str(tmp_path / "c.csv")
    got = read_raw(spark, path, "customer_master", ordered=False, multi_line=True)
    want = ("C1", 'Al "Ace", Ltd', "a@b.c", "1", "12 A\nRoad", "X", "Y", "Z", "2026-01-01")
    assert [tuple(r)[:9] for r in got.collect()] == [want]
    again = write_table(got.drop("src_row"), str(tmp_path / "d"), "csv")
    back = read_raw(spark, again, "customer_master", ordered=False, multi_line=True)
    assert [tuple(r)[:9] for r in back.collect()] == [want]
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_raw(spark, path, "customer_master", ordered=False).collect()


def test_writing_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("block", ["150", "20000", "100000000"])
def test_rows_of_plain_files_are_numbered_in_file_order(spark, tmp_path, block):
    columns = RAW_COLUMNS["bank_transactions"]
    n = 0
    folder = tmp_path / "bank_transactions"
    folder.mkdir()
    for part in range(3):
        lines = [",".join(columns)]
        for _ in range((30 if block == "150" else 2000) * (part + 1)):
            lines.append(",".join([f"B{n:06d}", *[""] * (len(columns) - 1)]))
            n += 1
        (folder / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in zip(names, (block, "1")):
            spark.conf.set(name, value)
        numbered = read_raw(spark, str(folder), "bank_transactions", ordered=False)
        got = numbered.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[0]
    assert initial.count("FileScan csv") == initial.count("FileScan binaryFile") == 1
    ordered = [r.bank_transaction_id for r in sorted(got, key=lambda r: r.src_row)]
    assert ordered == [f"B{i:06d}" for i in range(n)]
    assert len({r.src_row for r in got}) == n


@pytest.fixture
def small_blocks(spark):
    """Scans split files into blocks of some hundred bytes, and broadcast little by themselves."""
    values = {
        "spark.sql.files.maxPartitionBytes": "700",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.autoBroadcastJoinThreshold": "200000",
    }
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def bank_files(folder, sizes):
    columns = RAW_COLUMNS["bank_transactions"]
    folder.mkdir()
    n = 0
    for part, size in enumerate(sizes):
        rows = [",".join([f"B{n + i:06d}", *[""] * (len(columns) - 1)]) for i in range(size)]
        n += size
        (folder / f"part-{part:03d}.csv").write_text("\n".join([",".join(columns), *rows]) + "\n")
    return str(folder), n


def test_numbering_moves_no_rows(spark, tmp_path, small_blocks):
    path, _ = bank_files(tmp_path / "b", [3000, 2000, 10, 4000])
    got = read_raw(spark, path, "bank_transactions", ordered=False)
    assert spark.read.csv(path)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 10**5
    plan = got._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert "SortMergeJoin" not in initial and "Exchange hashpartitioning" not in initial
    assert initial.count("BroadcastHashJoin") == 1


def test_a_long_list_of_files_is_ranked_in_ranges(spark, tmp_path, small_blocks):
    path, n = bank_files(tmp_path / "b", [20 + 7 * i for i in range(40)])
    files = tables.list_files(spark, path)
    assert files.count() == 40
    few, at_once = rank_files(files)
    many, ranged = rank_files(files, at_once=5)
    assert at_once and not ranged
    order = sorted(r._file for r in files.collect())
    for ranks in (few, many):
        assert [r._file for r in sorted(ranks.collect(), key=lambda r: r._no)] == order
        assert sorted(r._no for r in ranks.collect()) == list(range(40))
    scan = spark.read.schema(tables.raw_schema("bank_transactions", with_order=False)).options(**tables.CSV_IN).csv(path)
    by_list = with_src_row(scan, path, "csv")
    # long files are several keys
    by_span = with_src_row(scan, path, "csv", at_once=5, span=256)
    got = {r.bank_transaction_id: r.src_row for r in by_span.collect()}
    assert got == {r.bank_transaction_id: r.src_row for r in by_list.collect()} and len(got) == n
    assert sorted(got, key=got.get) == sorted(got)


def test_line_breaks_in_fields_reach_the_stages(spark, tmp_path):
    raw = raw_tables(spark, FOLDER)
    for name, df in raw.items():
        if name == "customer_master":
            df = df.withColumn("address", F.lit("12 A\nRoad"))
        write_table(df.drop("src_row"), str(tmp_path / name), "csv")
    s = from_files(spark, str(tmp_path), ordered=False, multi_line=True)
    assert s.cleaned["customer_master"].select("address").distinct().collect()[0][0] == "12 A\nRoad"
    assert s.cleaned["customer_master"].count() == raw["customer_master"].count()
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        from_files(spark, str(tmp_path), ordered=False).cleaned  # noqa: B018


def test_rows_of_parquet_files_are_numbered_in_file_order(spark, tmp_path):
    columns = [F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS["bank_transactions"][1:]]
    rows = spark.range(0, 3000, 1, 4).select(F.format_string("B%06d", "id").alias("bank_transaction_id"), *columns)
    path = write_table(rows, str(tmp_path / "b"))
    got = read_raw(spark, path, "bank_transactions", "parquet", ordered=False).collect()
    ordered = [r.bank_transaction_id for r in sorted(got, key=lambda r: r.src_row)]
    assert ordered == [f"B{i:06d}" for i in range(3000)]


def test_stages_from_csv_files_equal_stages_from_tables(spark, tmp_path):
    raw = raw_tables(spark, FOLDER)
    for name, df in raw.items():
        write_table(df, str(tmp_path / name), "csv")
    a, b = Stages(spark, raw), from_files(spark, str(tmp_path))
    assert a.reconciliation.exceptAll(b.reconciliation).count() == 0
    assert b.reconciliation.exceptAll(a.reconciliation).count() == 0


def test_stages_hold_together(spark):
    s = Stages(spark, raw_tables(spark, FOLDER))
    assert s.folder.startswith(shared_folder(spark))
    rows = {r.table_name: r.row_count for r in table_counts(s.pick(list(RAW_COLUMNS))).collect()}
    recon, register = s.reconciliation.cache(), s.exceptions
    unexpected = recon.where("src_branch = 1").count()
    # every ledger row once, then the unexpected payments
    assert recon.count() == rows["erp_transactions"] + unexpected
    assert recon.where("src_branch = 0").select("src_row").distinct().count() == rows[
        "erp_transactions"
    ]
    assert register.count() == recon.where("reconciliation_status <> 'MATCHED'").count()
    numbers = sorted(int(r.exception_id[4:]) for r in register.select("exception_id").collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_exceptions_are_read_by_partition(spark):
    s = Stages(spark, raw_tables(spark, FOLDER))
    df = s.reconciliation.where("reconciliation_status <> 'MATCHED'").select("store_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reconciliation_status" in plan
    assert "ReadSchema: struct<store_id:string>" in plan


def test_stages_are_saved_and_removed(spark, tmp_path):
    s = Stages(spark, raw_tables(spark, FOLDER))
    n = s.exceptions.count()
    saved = s.save_all(str(tmp_path / "all"))
    assert len(saved) == 11
    assert spark.read.parquet(saved["exception_register"]).count() == n
    here = s.folder.removeprefix("file:")
    parts = [f for _, _, fs in os.walk(f"{here}/reconciliation") for f in fs if f.endswith(".parquet")]
    assert len(parts) <= 2 * 10
    s.close()
    assert not os.path.exists(here)


def test_missing_sources_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_raw(spark, str(tmp_path / "nowhere"))
