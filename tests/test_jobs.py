import glob
import os
import subprocess
import sys
from pathlib import Path

import pytest

from starledger import schemas
from starledger.__main__ import main
from starledger.operators.leaderboards import merged_counts
from starledger.plans import jobs
from starledger.sources import Store, parse_ratings, read_table, scan_lines, write_table

PRODUCTS = "1^ mouse ^c^x^u^k^t\n2^pen^c^x^u^k^t\n3^cup^c^x^u^k^t\n"
RATINGS = [
    (1, 1, 5.0, 1393632000), (1, 2, 3.0, 1393631999), (2, 1, 4.0, 1393632000),
    (2, 3, 1.0, 1393632000), (3, 2, 4.0, 1393632000), (3, 3, 2.0, 1393632000),
]


@pytest.fixture
def sources(tmp_path):
    (tmp_path / "products.csv").write_text(PRODUCTS)
    (tmp_path / "ratings.csv").write_text(
        "".join(",".join(map(str, rating)) + "\n" for rating in RATINGS)
    )
    return str(tmp_path / "products.csv"), str(tmp_path / "ratings.csv")


@pytest.mark.parametrize("indexed", [True, False])
def test_all_jobs(spark, sources, tmp_path, indexed):
    store = Store(str(tmp_path / "store"))
    jobs.load(spark, store, *sources, indexed=indexed)
    products = read_table(spark, store, "Product", schemas.PRODUCT)
    assert sorted(r.name for r in products.collect()) == ["cup", "mouse", "pen"]
    assert sorted(map(tuple, read_table(spark, store, "Rating", schemas.RATING).collect())) == RATINGS

    jobs.statistics(spark, store, files=1)
    board = read_table(spark, store, "RateMoreProducts", schemas.POPULAR)
    assert board.collect() == [(1, 2), (2, 2), (3, 2)]
    monthly = read_table(spark, store, "RateMoreRecentlyProducts", schemas.POPULAR_BY_MONTH)
    assert monthly.collect() == [(1, 2, 201403), (3, 2, 201403), (2, 1, 201403), (2, 1, 201402)]
    top = read_table(spark, store, "AverageProducts", schemas.TOP_RATED)
    assert top.collect() == [(1, 4.5), (2, 3.5), (3, 1.5)]
    assert len(glob.glob(f"{tmp_path}/store/AverageProducts/version-*/*.parquet")) == 1

    jobs.product_lists(spark, store, n=2, product_table="ProductRecs", cache=True)
    lists = read_table(spark, store, "UserRecs", schemas.USER_RECS).collect()
    assert sorted(r.userId for r in lists) == [1, 2, 3] and all(len(r.recs) <= 2 for r in lists)
    similar = read_table(spark, store, "ProductRecs", schemas.PRODUCT_RECS).collect()
    assert sorted(r.productId for r in similar) == [1, 2, 3]
    assert all(x.productId != r.productId for r in similar for x in r.recs)


def test_cached_ratings_take_no_memory_from_training(spark, sources, tmp_path, monkeypatch):
    store, levels = Store(str(tmp_path / "store")), []
    jobs.load(spark, store, *sources)
    train = jobs.train
    monkeypatch.setattr(jobs, "train", lambda ratings, *args, **named: levels.append(ratings.storageLevel) or train(ratings, *args, **named))
    for cache in (True, False):
        jobs.product_lists(spark, store, n=2, iterations=1, cache=cache)
    assert levels[0].useDisk and not levels[0].useMemory and not levels[1].useDisk


def test_text_months_and_other_names(spark, sources, tmp_path):
    store = Store(str(tmp_path / "store"), format="json")
    jobs.load(spark, store, *sources, product_table="Product2", rating_table="Rating2", trim=False)
    assert " mouse " in [
        r.name for r in read_table(spark, store, "Product2", schemas.PRODUCT).collect()
    ]
    jobs.statistics(
        spark, store, rating_table="Rating2", monthly_table="Monthly2", text_month=True,
        tz="Asia/Shanghai",
    )
    monthly = read_table(spark, store, "Monthly2", schemas.POPULAR_BY_MONTH_TEXT)
    assert {r.yearmonth for r in monthly.collect()} == {"201403"}


def test_a_bad_line_stops_a_strict_load_and_keeps_the_tables(spark, sources, tmp_path):
    store = Store(str(tmp_path / "store"))
    jobs.load(spark, store, *sources)
    with open(sources[1], "a") as ratings:
        ratings.write("1,2,oops\n")
    with pytest.raises(Exception, match="malformed rating line: 1,2,oops"):
        jobs.load(spark, store, *sources)
    assert read_table(spark, store, "Rating", schemas.RATING).count() == 6
    jobs.load(spark, store, *sources, mode="drop")
    assert read_table(spark, store, "Rating", schemas.RATING).count() == 6
    with open(sources[0], "a") as products:
        products.write("no product\n")
    jobs.load(spark, store, *sources, mode="permissive")
    assert read_table(spark, store, "Rating", schemas.RATING).count() == 6
    rejected = read_table(spark, store, "RejectedLines", "source string, value string")
    assert sorted(rejected.collect()) == [("products", "no product"), ("ratings", "1,2,oops")]
    places = store.load(spark, "RejectedLines").select("file", "block_start").collect()
    assert sorted((p.file.rpartition("/")[2], p.block_start) for p in places) == [("products.csv", 0), ("ratings.csv", 0)]
    jobs.load(spark, store, *sources, mode="permissive", max_rejected=2)
    with pytest.raises(ValueError, match="2 lines rejected, 1 of them in file:.*products.csv"):
        jobs.load(spark, store, *sources, mode="permissive", max_rejected=1)


def test_refreshing_reads_new_files_only_and_equals_a_full_run(spark, tmp_path):
    store, folder = Store(str(tmp_path / "store")), tmp_path / "ratings"
    folder.mkdir()
    boards = {"RateMoreProducts": schemas.POPULAR, "RateMoreRecentlyProducts": schemas.POPULAR_BY_MONTH,
              "AverageProducts": schemas.TOP_RATED}
    read = lambda: [sorted(map(tuple, read_table(spark, store, name, schema).collect())) for name, schema in boards.items()]
    assert jobs.refresh_statistics(spark, store, str(folder)) == []
    for part in range(3):
        new = folder / f"part-{part}"
        new.write_text("".join(",".join(map(str, rating)) + "\n" for rating in RATINGS[part::3]))
        (folder / "_SUCCESS").write_text("hidden")
        got = jobs.refresh_statistics(spark, store, str(folder))
        assert [path.rpartition("/")[2] for path in got] == [new.name]
        if part < 2:  # what is counted is not read again
            new.chmod(0)
    seen = read()
    assert jobs.refresh_statistics(spark, store, str(folder)) == [] and read() == seen
    for part in range(2):
        (folder / f"part-{part}").chmod(0o600)
    other = Store(str(tmp_path / "other"))
    write_table(parse_ratings(scan_lines(spark, str(folder))), other, "Rating")
    jobs.statistics(spark, other)
    store = other
    assert read() == seen
    store = Store(str(tmp_path / "store"))
    with pytest.raises(ValueError, match="months of UTC"):
        jobs.refresh_statistics(spark, store, str(folder), tz="Asia/Shanghai")
    with open(folder / "part-1", "a") as changed:
        changed.write("9,9,1.0,1393632000\n")
    with pytest.raises(ValueError, match="part-1 has changed"):
        jobs.refresh_statistics(spark, store, str(folder))
    assert read() == seen


def test_the_plan_of_a_refresh_has_the_new_files_only(spark, tmp_path, monkeypatch):
    store, folder = Store(str(tmp_path / "store")), tmp_path / "ratings"
    folder.mkdir()
    plans = []
    monkeypatch.setattr(jobs, "merged_counts", lambda a, b: plans.append(b.inputFiles()) or merged_counts(a, b))
    for part in range(2):
        (folder / f"part-{part}").write_text("1,1,5.0,1393632000\n")
        jobs.refresh_statistics(spark, store, str(folder))
    assert [[path.rpartition("/")[2] for path in files] for files in plans] == [["part-1"]]


def test_command_line(spark, sources, tmp_path):
    store = ["--root", str(tmp_path / "store"), "--format", "orc", "--option", "compression=zlib"]
    main([*store, "load", *sources, "--mode", "drop", "--no-trim"])
    main([*store, "statistics", "--text-month", "--files", "1"])
    main([*store, "refresh", sources[1], "--text-month"])
    main([*store, "product-lists", "-n", "1", "--unfiltered", "--iterations", "2"])
    read = lambda name, schema: read_table(
        spark, Store(str(tmp_path / "store"), "orc"), name, schema
    )
    assert read("RateMoreRecentlyProducts", schemas.POPULAR_BY_MONTH_TEXT).first()[2] == "201403"
    assert all(len(r.recs) == 1 for r in read("UserRecs", schemas.USER_RECS).collect())


def test_workers_do_not_need_the_package(tmp_path):
    """Run the Python-side operators from a folder where workers cannot import it."""
    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from starledger.operators import FactorModel, user_lists\n"
        "from starledger.operators.split_als import train_by_sums\n"
        "from starledger.shared import ensure_checkpoint_dir\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "ensure_checkpoint_dir(spark)\n"
        "ratings = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0), (2, 1, 4.0)],"
        " 'userId int, productId int, score double')\n"
        "model = FactorModel(*train_by_sums(ratings, 2, 1, 0.1, 0), 2)\n"
        "print('users', user_lists(model, min_score=None).count())\n"
    )
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=180,
    )
    assert "users 2" in done.stdout, done.stderr[-2000:]
