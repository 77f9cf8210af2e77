import glob

import pyarrow.parquet as pq
from starledger.operators.pages import page, ranked, write_ranked
from starledger.sources import Store

ORDER = ["neg", "productId"]


def board(spark, n):
    return spark.range(n, numPartitions=6).selectExpr("int(id) as productId", "(id * 7919) % 1000 as count", "-((id * 7919) % 1000) as neg")


def test_ranks_equal_a_window_over_all(spark):
    rows = ranked(board(spark, 5000), ORDER).collect()
    assert [r.rank for r in sorted(rows, key=lambda r: (-r["count"], r.productId))] == list(range(1, 5001))
    assert ranked(board(spark, 0), ORDER).collect() == []
    plan = ranked(board(spark, 50), ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_a_page_is_in_one_row_group(spark, tmp_path):
    options = {"parquet.block.size": str(1 << 16), "parquet.page.size": str(1 << 12)}
    store = Store(str(tmp_path), options=options)
    write_ranked(board(spark, 200_000), ORDER, store, "Ranked")
    groups = []
    for path in glob.glob(f"{tmp_path}/Ranked/version-*/*.parquet"):
        file = pq.ParquetFile(path)
        place = file.schema_arrow.names.index("rank")
        for g in range(file.num_row_groups):
            stats = file.metadata.row_group(g).column(place).statistics
            groups.append((stats.min, stats.max))
    groups.sort()
    assert len(groups) > 20 and all(a[1] < b[0] for a, b in zip(groups, groups[1:]))
    first = groups[10][0] + 5
    rows = page(spark, store, "Ranked", first, first + 20)
    assert [r.rank for r in rows.collect()] == list(range(first, first + 21))
    assert sum(low <= first + 20 and high >= first for low, high in groups) == 1
    assert "GreaterThanOrEqual(rank" in rows._jdf.queryExecution().executedPlan().toString()
