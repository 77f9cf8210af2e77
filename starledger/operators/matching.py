"""The best products of every user by dot product, without forming the pairs.

Users are split into blocks of bounded size. A task holds the users of one block and their lists, and the
products reach it in a stream, longest vectors first, of which it holds a piece at a time; as no
score exceeds the product of the two lengths, a user whose n-th best no shorter product can reach
is settled. So memory does not grow with the products, lists come out whole, and what is shuffled is
each user once and the products once per block. Of equal vectors only those products that a list can
reach, the lowest ids, are searched.

Where a size of shards is given, products are also cut into shards by length. They are searched in rounds
of 1, 2, 4, ... of them, and users who are settled after a round are sent to no further shard.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from starledger import schemas
from starledger.operators.ranking import to_lists, top_n
from starledger.shared import new_folder, stored

# The functions below travel with the job, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bounds on what one task holds: numbers of its users' vectors or lists (32 MB of vectors), and users.
VALUES_PER_SIDE = 4_000_000
USERS_PER_BLOCK = 262_144

# Below this, splitting users further would cost more in product copies than it saves.
_MIN_USERS_PER_BLOCK = 1024
_USER_TILE = 256
_PRODUCT_TILE = 4096

#: Room for the rounding of angles and of their cosines.
_ANGLE_ROOM, _COSINE_ROOM = 1e-6, 1e-9


def best_matches(
    user_factors: DataFrame,
    item_factors: DataFrame,
    n: int = 20,
    min_score: float | None = 0.0,
    exclude_same_id: bool = False,
    users_per_block: int | None = None,
    products_per_shard: int | None = None,
) -> DataFrame:
    """(userId, recs) with each user's ``n`` products of highest score, best first.

    Only scores strictly above ``min_score`` count; ``None`` keeps all. Equal scores rank
    by ``productId``. Users without any product are absent.

    The sizes of blocks and shards do not change the result: so many users and products at most are
    compared at once. A task has several blocks, as many as it can hold, one after the other.
    """
    users = user_factors.select(
        "userId",
        F.col("features").alias("user_vector"),
        F.lit(-math.inf if min_score is None else min_score).alias("needed"),
    )
    items = item_factors.select("productId", F.col("features").alias("item_vector"))
    items = without_copies(items, n + exclude_same_id)
    matcher = _cell_matcher(n, min_score, exclude_same_id)
    shards = 1
    if products_per_shard is not None:
        items = stored(items, f"{new_folder(items.sparkSession, 'matches')}/items")
        shards = max(math.ceil(items.count() / products_per_shard), 1)
    if shards == 1:
        only = F.lit(0).alias("cell")
        return searched(users.select("*", only), items.select("*", only), matcher, users_per_block, products_per_shard)
    rounds = by_length(users, items, n, matcher, shards, users_per_block, products_per_shard)
    lists = [settled.select("userId", "recs") for _, settled in rounds]
    together = lists[0]
    for part in lists[1:]:
        together = together.union(part)
    return together.where(F.size("recs") > 0)


def bounds(rank: int, n: int) -> tuple[int, int]:
    """Users that a task holds with lists of ``n``, and products of as many numbers."""
    return max(min(USERS_PER_BLOCK, VALUES_PER_SIDE // max(rank, n)), 1), max(VALUES_PER_SIDE // rank, 1)


def without_copies(items: DataFrame, wanted: int) -> DataFrame:
    """The products without the copies of a vector that no list can reach.

    Copies score the same for every user, so only the ``wanted`` lowest ids can be listed.
    """
    of_vector = Window.partitionBy("item_vector").orderBy("productId")
    return items.withColumn("_copy", F.row_number().over(of_vector)).where(F.col("_copy") <= wanted).drop("_copy")


def by_length(
    users: DataFrame, items: DataFrame, n: int, matcher, shards: int, users_per_block: int, products_per_shard: int
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Search shards by length; of each round the users searched for, and those settled by it.

    Users have ``userId``, ``user_vector`` and ``needed``, the score that a product must reach;
    items have ``productId`` and ``item_vector``. What is settled has ``userId`` and ``recs``.
    """
    folder = new_folder(users.sparkSession, "matches")
    # Copies of a vector are as long as each other: the id parts them as well.
    sized = items.withColumn("length", _length("item_vector"))
    ranged = sized.repartitionByRange(shards, F.desc("length"), "productId")
    ranged = stored(ranged.withColumn("cell", F.spark_partition_id()), f"{folder}/shards")
    tops = ranged.groupBy("cell").agg(F.max("length").alias("top")).orderBy("cell").collect()
    none = F.expr(f"cast(array() as {schemas.RECOMMENDATIONS})")
    state = users.select("*", _length("user_vector").alias("length"), none.alias("recs"))
    at, width = 0, 1
    while at < len(tops):
        active = state.where(_may_reach(tops[at].top))
        if at and active.isEmpty():
            break
        last = min(at + width, len(tops)) - 1
        visited = ranged.where(F.col("cell").between(tops[at].cell, tops[last].cell))
        # The shards of a round are one cell: they reach a user in one stream, which gives one list.
        only = F.lit(0).alias("cell")
        visits = active.select("userId", "user_vector", "needed", only)
        visited = visited.select("productId", "item_vector", only)
        found = searched(visits, visited, matcher, users_per_block, products_per_shard)
        state = stored(with_found(active, found, n), f"{folder}/users-{at}")
        at, width = at + width, 2 * width
        settled = state if at >= len(tops) else state.where(~_may_reach(tops[at].top))
        yield active, settled


def with_found(state: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """Users with the lists found merged into ``recs``, and the score they ``need`` now."""
    listed = lambda lists: lists.select("userId", F.explode("recs").alias("rec")).select("userId", "rec.*")
    best = to_lists(top_n(listed(state).union(listed(found)), n, None))
    merged = state.drop("recs").join(best, "userId", "left")
    nth = F.get("recs", F.lit(n - 1))["score"]
    none = F.expr(f"cast(array() as {schemas.RECOMMENDATIONS})")
    return merged.withColumns({"needed": F.coalesce(nth, F.col("needed")), "recs": F.coalesce("recs", none)}).select(
        state.columns
    )


def searched(
    visits: DataFrame,
    items: DataFrame,
    matcher: Matcher,
    users_per_block: int | None = None,
    products_per_shard: int | None = None,
    cells: Broadcast | None = None,
) -> DataFrame:
    """(userId, recs) of users in the cells that they visit, one list per cell.

    Both sides have a ``cell``. Users of a cell are cut into blocks of what a task holds; small cells
    share a task, which searches one after the other. Products of a cell reach all blocks of it.
    At most ``users_per_block`` users and ``products_per_shard`` products are compared at once.

    With ``cells``, the pivots and widest angles of smaller ones, both sides also have their ``home`` of
    these: a user meets the products of those other than the own that may have a better one.
    """
    spark = visits.sparkSession
    users = dict(visits.groupBy("cell").count().collect())  # as many rows as cells
    sized = items.groupBy("cell").agg(F.count("*").alias("n"), F.max(F.size("item_vector")).alias("rank")).collect()
    products = {row.cell: row.n for row in sized}
    per_task, _ = bounds(max((row.rank for row in sized), default=1) or 1, matcher.n)
    cores = spark.sparkContext.defaultParallelism
    found = sorted(users.keys() & products.keys())
    work = lambda cell: users[cell] * products[cell]
    share = sum(map(work, found)) / (4 * cores)
    total, plan, shared_work, shared_users = 0, [], 0, 0
    for cell in found:
        spread = math.ceil(cores / len(users))
        blocks = max(
            math.ceil(users[cell] / per_task), min(spread, math.ceil(users[cell] / _MIN_USERS_PER_BLOCK))
        )
        fits = shared_work and shared_work + work(cell) <= share and shared_users + users[cell] <= per_task
        if blocks == 1 and fits:
            first = total - 1
        else:
            first, total, shared_work, shared_users = total, total + blocks, 0, 0
        if blocks == 1:
            shared_work, shared_users = shared_work + work(cell), shared_users + users[cell]
        plan.append((cell, blocks, first))
    if not plan:
        return spark.createDataFrame([], schemas.USER_RECS)
    home = (lambda rows: F.col("home") if "home" in rows.columns else F.lit(0).alias("home"))
    block = F.pmod(F.hash("userId"), F.col("blocks"))
    copies = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("copy")
    group = lambda block: (F.col("first") + block).cast("int").alias("group")
    ours = _planned(visits, plan).select(
        group(block), "cell", F.lit(0).alias("side"), home(visits), F.lit(0.0).alias("length"),
        F.col("userId").alias("id"), F.col("user_vector").alias("vector"), "needed",
    )
    theirs = items.withColumn("length", _length("item_vector"))
    theirs = _planned(theirs, plan).select("*", copies).select(
        group(F.col("copy")), "cell", F.lit(1).alias("side"), home(items), "length",
        F.col("productId").alias("id"), F.col("item_vector").alias("vector"), F.lit(None).cast("double").alias("needed"),
    )
    order = ["group", "cell", "side", "home", F.desc("length"), "id"]
    # One task per group: they are few and heavy, so hash collisions would leave cores idle.
    return (
        ours.union(theirs)
        .repartitionById(total, F.col("group"))
        .sortWithinPartitions(*order)
        .mapInArrow(_streamed(matcher, users_per_block, products_per_shard, cells), schemas.USER_RECS)
    )


def _planned(rows: DataFrame, plan: list[tuple]) -> DataFrame:
    """The rows of planned cells with ``blocks`` and the ``first`` group of their cell."""
    if len(plan) == 1:
        cell, blocks, first = plan[0]
        return rows.where(F.col("cell") == cell).select(
            "*", F.lit(blocks).alias("blocks"), F.lit(first).alias("first")
        )
    cells = rows.sparkSession.createDataFrame(plan, "cell int, blocks int, first int")
    return rows.join(F.broadcast(cells), "cell")


def _length(vector: str) -> Column:
    """Euclidean length; a vector that is not finite counts as infinitely long."""
    value = lambda x: x.cast("double")
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + value(x) * value(x)))
    return F.nanvl(length, F.lit(math.inf))


def _may_reach(longest: float) -> Column:
    """Whether products of a length may matter to a user; with room for rounding."""
    reach = F.col("length") * F.lit(longest) * (1 + 1e-9)
    return F.isnan("needed") | ~(reach < F.col("needed"))


@dataclass(frozen=True)
class Matcher:
    """What is asked of a list: its size, the bound of scores, and whether the own id is left out."""

    n: int
    min_score: float | None
    exclude_same_id: bool


def _cell_matcher(n: int, min_score: float | None, exclude_same_id: bool) -> Matcher:
    return Matcher(n, min_score, exclude_same_id)


def _streamed(matcher: Matcher, users_per_block: int | None, products_per_shard: int | None, cells):
    user_tile = min(users_per_block or _USER_TILE, _USER_TILE)
    product_tile = min(products_per_shard or _PRODUCT_TILE, _PRODUCT_TILE)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.empty(user_tile * product_tile)
        at, users, tiles = None, [], []
        for place, side, rows in _runs(batches):
            if place != at:
                yield from _lists_of(tiles)
                at, users, tiles = place, [], []
            if side == 0:
                users.append(rows)
                continue
            if users:
                tiles, users = _tiles(users, user_tile, matcher), []
            for start in range(0, rows.num_rows, product_tile):
                if not cells:
                    tiles_left = [tile for tile in tiles if len(tile.active)]
                else:
                    tiles_left = tiles
                if tiles_left:
                    piece = _Piece(rows.slice(start, product_tile))
                    for tile in tiles_left:
                        tile.meet(piece, scratch, cells and cells.value)
        yield from _lists_of(tiles)

    return match


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Rows of one group, cell and side at a time, in their order."""
    for rows in batches:
        keys = np.stack([rows.column(k).to_numpy() for k in range(3)])
        starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))[: rows.num_rows])
        for start, end in zip(starts, np.append(starts[1:], rows.num_rows)):
            group, cell, side = keys[:, start]
            yield (group, cell), side, rows.slice(start, end - start)


def _tiles(users: list[pa.RecordBatch], size: int, matcher: Matcher) -> list[_Tile]:
    ids, homes, needed = (
        np.concatenate([rows.column(name).to_numpy() for rows in users]) for name in ("id", "home", "needed")
    )
    vectors = np.concatenate([_vectors(rows) for rows in users])
    users.clear()
    cut = lambda values, at: values[at : at + size].copy()
    return [
        _Tile(matcher, cut(ids, at), cut(vectors, at), cut(needed, at), cut(homes, at)) for at in range(0, len(ids), size)
    ]


def _lists_of(tiles: list[_Tile]) -> Iterator[pa.RecordBatch]:
    for tile in tiles:
        tile.merge()
        if len(tile.best[0]):
            yield _as_lists(tile.ids, *tile.best)


class _Piece:
    """A few products, with a column per product."""

    def __init__(self, rows: pa.RecordBatch):
        vectors = _vectors(rows)
        self.ids = rows.column("id").to_numpy()
        self.lengths = _lengths(vectors)
        self.columns = np.ascontiguousarray(vectors.T)
        self.homes, self.home = np.unique(rows.column("home").to_numpy(), return_inverse=True)


class _Tile:
    """A few users with their best products so far as (row, product, score), by row and rank.

    ``needed`` is what a product must reach to matter to a user: the bound, or the n-th best from
    elsewhere, and then the n-th best so far. ``active`` are users whom a product to come may reach.
    """

    def __init__(self, matcher: Matcher, ids, vectors, needed, homes):
        self.matcher, self.ids, self.vectors, self.needed, self.homes = matcher, ids, vectors, needed, homes
        self.lengths = _lengths(vectors)
        self.active = np.arange(len(ids))
        self.best = (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0))
        self.fresh, self.waiting = [], 0

    def meet(self, piece: _Piece, scratch, cells) -> None:
        """Take in the products of a piece that may matter.

        A matrix product finds the candidates; its rounding depends on the machine, so they are let
        through with some slack and scored again in index order.
        """
        matcher = self.matcher
        ids, tile, longest = piece.ids, piece.columns, piece.lengths.max()
        rounding = 4 * len(tile) * np.finfo(float).eps
        with np.errstate(invalid="ignore", over="ignore"):
            active = self.active
            active = active[~(self.lengths[active] * longest * (1 + rounding) < self.needed[active])]
            if cells:
                worth = worth_visiting(
                    self.vectors[active], cells, self.needed[active], self.homes[active], piece.homes
                )
                some, columns = worth.any(axis=1), worth.any(axis=0)[piece.home]
                active, worth = active[some], worth[some][:, piece.home[columns]]
                if not columns.all():
                    ids, tile = ids[columns], tile[:, columns]
            else:
                # Pieces to come have no longer vectors.
                self.active = active
            if len(active) == 0:
                return
            width = tile.shape[1]
            needed = self.needed[active]
            slack = self.lengths[active] * longest * rounding
            rough = scratch[: len(active) * width].reshape(len(active), width)
            np.matmul(self.vectors[active], tile, out=rough)
            possible = ~(rough < (needed - slack)[:, None])
            if cells:
                possible &= worth
            wanted = matcher.n + matcher.exclude_same_id
            if not cells and wanted < width and np.count_nonzero(possible) > 8 * wanted * len(active):
                nth = np.partition(rough, width - wanted, axis=1)[:, width - wanted]
                possible &= ~(rough < (nth - 2 * slack)[:, None])
            row, column = np.divmod(np.flatnonzero(possible), width)
            row = active[row]
            score = np.zeros(len(row))
            for k in range(len(tile)):
                score += self.vectors[row, k] * tile[k, column]
        product = ids[column]
        kept = ~(score < self.needed[row])
        if matcher.min_score is not None:
            kept &= score > matcher.min_score
        if matcher.exclude_same_id:
            kept &= self.ids[row] != product
        if not kept.any():
            return
        self.fresh.append((row[kept].astype(np.int32), product[kept], score[kept]))
        self.waiting += len(self.fresh[-1][0])
        # Sorted in when there are about as many as the lists have, not after every piece.
        if self.waiting >= matcher.n * len(active):
            self.merge()

    def merge(self) -> None:
        if not self.fresh:
            return
        n = self.matcher.n
        self.best = best = _first_n(*(np.concatenate(parts) for parts in zip(self.best, *self.fresh)), n)
        self.fresh, self.waiting = [], 0
        last = np.flatnonzero(np.bincount(best[0], minlength=len(self.ids)) == n)
        nth = best[2][np.searchsorted(best[0], last, side="right") - 1]
        self.needed[last] = np.fmax(self.needed[last], nth)


def worth_visiting(vectors, cells, needed, homes, at=slice(None)) -> np.ndarray:
    """Whether each of some cells but the own may have a better product for each user.

    ``cells`` are the pivots and the widest angle to a product of each, -1 for none.
    """
    pivots, widest = cells
    angles = np.arccos(np.clip(vectors @ pivots[at].T, -1, 1))
    nearest = np.maximum(angles - widest[at] - _ANGLE_ROOM, 0)
    worth = np.cos(nearest) + _COSINE_ROOM >= needed[:, None]
    return worth & (widest[at] >= 0) & (np.arange(len(pivots))[at] != homes[:, None])


def _first_n(row, product, score, n):
    """Sort by row, then score from the top (NaN first, as Spark sorts), then product."""
    number = ~np.isnan(score)
    order = np.lexsort((product, -score, number, row))
    row, product, score = row[order], product[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    kept = rank < n
    return row[kept], product[kept], score[kept]


def _lengths(vectors):
    """Euclidean lengths; a vector that is not finite counts as infinitely long."""
    with np.errstate(invalid="ignore", over="ignore"):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
    return np.where(np.isnan(lengths), np.inf, lengths)


def _vectors(rows: pa.RecordBatch) -> np.ndarray:
    flat = rows.column("vector").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows.num_rows, -1).astype(np.float64)


def _as_lists(user_ids, row, product, score) -> pa.RecordBatch:
    users, sizes = np.unique(row, return_counts=True)
    recs = pa.StructArray.from_arrays(
        [pa.array(product, pa.int32()), pa.array(score, pa.float64())], ["productId", "score"]
    )
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), recs)
    return pa.RecordBatch.from_arrays([pa.array(user_ids[users], pa.int32()), lists], ["userId", "recs"])
