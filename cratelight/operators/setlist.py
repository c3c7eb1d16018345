"""Next-song recommendation and greedy setlists under tempo and key limits."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelight.functions.harmony import compatible_keys
from cratelight.operators.align import only_known
from cratelight.operators.pooling import running_sum
from cratelight.operators.similarity import Blocks, block_nearest, fits_in_one, keep_nearest, meeting
from cratelight.session import Bucketed, cut_lineage


CELL_SONGS = 1024


def _bucket(bpm: Column, width: float) -> Column:
    """Tempo bucket of a width, or 1 for a band of one tempo."""
    return F.floor(bpm / F.lit(float(width) or 1.0)).cast("long")


def cell_width(songs: DataFrame, window: float) -> float:
    """Width of a tempo bucket: that of the band, or more while a key has fewer than ``CELL_SONGS`` songs a bucket.

    Any width finds the same songs; too many small cells only cost calls.
    """
    facts = songs.agg(F.count("*").alias("n"), F.approx_count_distinct("initialkey").alias("keys"), F.min("bpm").alias("low"), F.max("bpm").alias("high")).first()
    narrow = float(window) or 1.0
    if not facts["n"] or not math.isfinite(facts["high"] - facts["low"]):
        return narrow
    buckets = max(1, facts["n"] // (max(1, facts["keys"]) * CELL_SONGS))
    return max(narrow, (facts["high"] - facts["low"]) / buckets)


def _keyed(tags: DataFrame) -> DataFrame:
    return tags.select("sid", F.col("bpm").cast("double").alias("bpm"), "initialkey").where("bpm IS NOT NULL AND initialkey IS NOT NULL")


def playable(tags: DataFrame, vectors: DataFrame) -> DataFrame:
    """Songs that can be recommended: with tempo, key and vector."""
    return _keyed(tags).join(vectors.select("sid", "embedding").where(F.size("embedding") > 0), "sid")


CELL = ["cell_key", "cell_bpm"]


def _cells_of_seeds(seeds: DataFrame, bpm_window: float, key_thresh: int, width: float) -> DataFrame:
    # from the same bounds that the band is checked with: rounding is monotonic, so no bucket of the band is left out
    first, last = _bucket(F.col("bpm") - bpm_window, width), _bucket(F.col("bpm") + bpm_window, width)
    keys = seeds.withColumn("cell_key", F.explode(compatible_keys(F.col("initialkey"), key_thresh)))
    return keys.withColumn("cell_bpm", F.explode(F.sequence(first, last)))


def _cells_of_songs(songs: DataFrame, width: float) -> DataFrame:
    return songs.withColumn("cell_key", F.col("initialkey")).withColumn("cell_bpm", _bucket(F.col("bpm"), width))


def best_next(
    seeds: DataFrame, songs: DataFrame, bpm_window: float = 5, key_thresh: int = 2, metric: str = "cosine",
    width: float | None = None,
) -> DataFrame:
    """(seed, sid, distance): the nearest song within tempo and key limits of each seed.

    seeds: seed, bpm, initialkey, embedding, excluded (array of sids that may not be picked). The band on bpm becomes
    an equality on tempo buckets and the key rule an equality on compatible keys, so songs only meet inside one
    (key, bucket) cell; seeds with nothing to play are absent.
    """
    width = width or bpm_window
    cells, stock = _cells_of_seeds(seeds, bpm_window, key_thresh, width), _cells_of_songs(songs, width)
    found = block_nearest(cells, stock, 1, metric, CELL, bpm_window)
    return keep_nearest(found, 1).drop("rank")


def next_song(
    tags: DataFrame, vectors: DataFrame, seeds: DataFrame | None = None, bpm_window: float = 5, metric: str = "cosine",
    key_thresh: int = 2,
) -> DataFrame:
    """(seed, sid, distance) for each seed song; ``seeds`` holds sid and optionally ``excludes`` (array of sids)."""
    songs = playable(tags, vectors)
    chosen = songs
    if seeds is not None:
        chosen = songs.join(seeds, "sid") if "excludes" in seeds.columns else only_known(songs, seeds)
    own = F.array("sid")
    excluded = F.concat(own, F.coalesce("excludes", F.array().cast(f"array<{dict(songs.dtypes)['sid']}>"))) if "excludes" in chosen.columns else own
    chosen = chosen.withColumn("seed", F.col("sid")).withColumn("excluded", excluded)
    return best_next(chosen, songs, bpm_window, key_thresh, metric, cell_width(_keyed(tags), bpm_window))


class Stock:
    """The songs of all steps, written twice: clustered by cell and block for the comparison, and by ``sid`` for their vectors.

    Neither is shuffled afterwards, except blocks of cells with more seeds than one block holds: seeds of the first slice of a cell
    go to the stored block, and only those of the other slices get copies of it.
    """

    def __init__(self, songs: DataFrame, bpm_window: float, key_thresh: int, metric: str):
        self.window, self.thresh, self.metric = bpm_window, key_thresh, metric
        self.by_sid = Bucketed(songs.select("sid", "bpm", "initialkey", "embedding"), "stock_songs", ["sid"])
        songs = self.by_sid.table
        self.width = cell_width(songs, bpm_window)
        cells = _cells_of_songs(songs, self.width)
        self.blocks = Blocks(cells, CELL)
        numbered = self.blocks.add(cells, "_n_cb").withColumn("_cb", F.pmod(F.xxhash64("sid"), F.col("_n_cb")).cast("int"))
        self.by_cell = Bucketed(numbered.select(*CELL, "_cb", "sid", "bpm", "embedding"), "stock_cells", [*CELL, "_cb"])

    def __enter__(self) -> Stock:
        return self

    def __exit__(self, *_) -> None:
        for stored in (self.by_cell, self.by_sid):
            stored.__exit__()

    def located(self, walks: DataFrame) -> DataFrame:
        """(seed, sid, excluded) with tempo, key and vector of the song each walk is at."""
        return walks.join(self.by_sid.table, "sid")

    def step(self, walks: DataFrame, few_seeds: bool = False) -> DataFrame:
        """(seed, sid): the best next song of every walk (seed, excluded, bpm, initialkey, embedding)."""
        return self.best(walks, 1, few_seeds).select("seed", "sid")

    def followers(self, n: int) -> Bucketed:
        """(sid, followers): the ``n`` best next songs of every song, best first; written, clustered by ``sid``."""
        everyone = self.by_sid.table.withColumn("seed", F.col("sid")).withColumn("excluded", F.array("sid"))
        ranked = self.best(everyone, n).groupBy("seed").agg(F.sort_array(F.collect_list(F.struct("rank", "sid"))).alias("ranked"))
        return Bucketed(ranked.select(F.col("seed").alias("sid"), F.col("ranked.sid").alias("followers")), "stock_followers", ["sid"])

    def best(self, walks: DataFrame, n: int, few_seeds: bool = False) -> DataFrame:
        """(seed, sid, distance, rank): the ``n`` best next songs of every walk."""
        cells = _cells_of_seeds(walks, self.window, self.thresh, self.width)
        seed_blocks = Blocks(cells, CELL, fits=few_seeds)
        left = self.blocks.add(seed_blocks.add(cells, "_n_sb"), "_n_cb").select(
            *CELL, F.pmod(F.xxhash64("seed"), F.col("_n_sb")).cast("int").alias("_sb"),
            F.explode(F.sequence(F.lit(0), F.col("_n_cb") - 1)).alias("_cb"), "seed", "embedding", "excluded", "bpm",
        )
        stock = self.by_cell.table
        meet, schema = meeting(n, self.metric, self.window), f"seed {dict(left.dtypes)['seed']}, sid {dict(stock.dtypes)['sid']}, distance double"
        group = [*CELL, "_cb"]
        found = left.where("_sb = 0").groupBy(*group).cogroup(stock.groupBy(*group)).applyInArrow(meet, schema)
        if seed_blocks.counts is not None:
            crowded = seed_blocks.counts.where("n > 1").select(*CELL, F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("_sb"))
            copies, group = stock.join(crowded, CELL), [*group, "_sb"]
            found = found.unionByName(left.where("_sb > 0").groupBy(*group).cogroup(copies.groupBy(*group)).applyInArrow(meet, schema))
        return keep_nearest(found, n)


def _once(songs: DataFrame) -> bool:
    """Whether every song has one row."""
    return not songs.groupBy("sid").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()


def _followed(walks: DataFrame, known: DataFrame) -> DataFrame:
    """``walks`` with ``_next``: the best follower of the song each is at that it has not played."""
    left = F.array_except("followers", "excluded")
    return walks.join(known, "sid", "left").select("seed", "excluded", F.get(left, F.lit(0)).alias("_next"))


def _walked(walks: DataFrame, n_songs: int, step: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """(seed, excluded) of the walks still going after ``n_songs`` steps, and of those that ended at each step."""
    ended = []
    for _ in range(n_songs):
        moved = cut_lineage(step(walks).select(
            "seed", F.col("_next").alias("sid"),
            F.when(F.col("_next").isNull(), F.col("excluded")).otherwise(F.array_append("excluded", F.col("_next"))).alias("excluded"),
        ))
        ended.append(moved.where("sid IS NULL").select("seed", "excluded"))
        walks = moved.where("sid IS NOT NULL")
    return walks.select("seed", "excluded"), ended


def setlists(
    tags: DataFrame, vectors: DataFrame, seeds: DataFrame | None = None, n_songs: int = 10, bpm_window: float = 5,
    metric: str = "cosine", key_thresh: int = 2,
) -> DataFrame:
    """(seed, order, sid): from each seed, ``n_songs`` times the best next song, never repeating.

    All seeds advance together, one job per step; the loop only counts steps. A walk with nothing left to play ends
    early. Songs are written once (``Stock``); a step carries ids alone and is written to the shared checkpoint folder, so a lost
    executor repeats one step at most.

    Walks that take more steps together than there are songs share the comparisons: the ``n_songs`` best next songs of every song are found
    once, and a step takes the first that the walk has not played. That is exact, as a walk has played less than ``n_songs`` songs besides
    the one it is at. Fewer walks compare at each step, and so do songs with several rows.
    """
    songs = playable(tags, vectors)
    with Stock(songs, bpm_window, key_thresh, metric) as stock:
        everyone = stock.by_sid.table
        start = everyone if seeds is None else only_known(everyone, seeds)
        walks = start.select(F.col("sid").alias("seed"), "sid", F.array("sid").alias("excluded"))
        if n_songs > 1 and (seeds is None or start.count() * n_songs >= everyone.count()) and _once(everyone):
            with stock.followers(n_songs) as known:
                paths, ended = _walked(walks, n_songs, lambda at: _followed(at, known.table))
        else:
            few_seeds = fits_in_one(start)
            # seeds move to other cells, so unless they fit in one block they are counted again
            paths, ended = _walked(walks, n_songs, lambda at: at.join(
                stock.step(stock.located(at), few_seeds).withColumnRenamed("sid", "_next"), "seed", "left"))
        if n_songs < 1:
            paths = cut_lineage(paths)
    for part in ended:
        paths = paths.unionByName(part)
    return paths.select("seed", F.posexplode("excluded").alias("_pos", "sid")).select(
        "seed", (F.col("_pos") + 1).alias("order"), "sid"
    )


def candidate_pool(tags: DataFrame, bpm_window: float = 5, key_thresh: int = 2) -> DataFrame:
    """(sid, n_candidates): how many other songs are within tempo and key limits, without forming the pairs.

    Songs are first counted per (key, bpm). Each (key, bpm) then asks for two running counts per compatible key, one
    at either end of its band, and the pool is the difference.
    """
    songs = _keyed(tags)
    counts = songs.groupBy("initialkey", "bpm").agg(F.count("*").alias("c"))
    asked = counts.select("initialkey", "bpm", F.explode(compatible_keys(F.col("initialkey"), key_thresh)).alias("key"))
    # at one tempo: band starts come before the songs counted there, band ends after them
    data = counts.select(F.col("initialkey").alias("key"), F.col("bpm").alias("x"), F.lit(1).alias("side"), "c",
                         F.lit(None).cast("string").alias("initialkey"), F.lit(None).cast("double").alias("bpm"))
    edges = [
        asked.select("key", edge.alias("x"), F.lit(side).alias("side"), F.lit(0).cast("long").alias("c"), "initialkey", "bpm")
        for edge, side in ((F.col("bpm") - bpm_window, 0), (F.col("bpm") + bpm_window, 2))
    ]
    line = data.unionByName(edges[0]).unionByName(edges[1])
    summed = running_sum(
        line, ["key"], _bucket(F.col("x") * 64, bpm_window), ["x", "side", "initialkey", "bpm"], F.col("c"), "upto"
    )
    pools = summed.where("side <> 1").groupBy("initialkey", "bpm").agg(
        (F.sum(F.when(F.col("side") == 2, F.col("upto")).otherwise(-F.col("upto"))) - 1).alias("n_candidates")
    )
    return songs.join(pools, ["initialkey", "bpm"]).select("sid", "n_candidates")
