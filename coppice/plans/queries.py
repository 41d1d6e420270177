"""Every operator as a query over the given tables.

Each function takes a session and a folder of parquet tables. Heights and
distances are rounded to six places so that other engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.functions import classify
from coppice.functions.vectors import euclidean, euclidean_squared, lance_williams
from coppice.operators import compare, components, cut, dendrogram, linkage, mst, nearest
from coppice.plans import runlog
from coppice.sources import convert, dendrograms, points
from coppice.sources import runlog as runlog_files
from coppice.store import Store

Query = Callable[[SparkSession, str], DataFrame]
PLACES = 6
CUT_K = 10
CUT_LABELS_K = 20
CUT_SUPPLIER_K = 5
BLOCKS_SMALL = 16  # forces the forms for many blocks, parts and pieces on a small table
BLOCKS_APART = 96  # a second block size, to show that the layout does not matter


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return points.vector_points(_table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    return points.as_points(rows, "s_suppkey")


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """Size alone: fifty values, so most points are copies and most distances tie."""
    rows = _table(spark, folder, "part").select("p_partkey", "p_size")
    return points.as_points(rows, "p_partkey")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return points.as_points(rows, "c_custkey")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, PLACES))
    return df


# --- distances ---------------------------------------------------------------


def pairwise_distance(spark, folder):
    return _rounded(nearest.pairwise_distances(_embeddings(spark, folder)), "w")


def distance_column(spark, folder):
    rows = _embeddings(spark, folder)
    following = rows.select((F.col("id") - 1).alias("id"), F.col("features").alias("y"))
    pairs = rows.withColumnRenamed("features", "x").join(following, "id")
    return _rounded(
        pairs.select("id", euclidean_squared("x", "y").alias("squared"), euclidean("x", "y").alias("w")),
        "squared",
        "w",
    )


def closest_pair(spark, folder):
    return _rounded(nearest.closest_pair(_embeddings(spark, folder)), "w")


def nearest_neighbor(spark, folder):
    return _rounded(nearest.nearest_neighbors(_embeddings(spark, folder)), "w")


def nearest_neighbor_ties(spark, folder):
    return _rounded(nearest.nearest_neighbors(_parts(spark, folder)), "w")


def lance_williams_update(spark, folder):
    rows = _table(spark, folder, "lineitem")
    args = ("l_extendedprice", F.col("l_quantity") * 1000, F.col("l_linenumber"), "l_quantity")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[lance_williams(*args, kind).alias(kind) for kind in ("single", "complete", "average")],
    )


# --- graphs ------------------------------------------------------------------


def _geography(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and suppliers to nations to regions, as one undirected graph.

    Ids of the four kinds are kept apart by their remainder modulo 4.
    """
    nation = _table(spark, folder, "nation")
    return (
        _table(spark, folder, "customer")
        .select((F.col("c_custkey") * 4 + 3).alias("u"), (F.col("c_nationkey").cast("long") * 4 + 1).alias("v"))
        .unionAll(
            _table(spark, folder, "supplier").select(
                F.col("s_suppkey") * 4 + 2, F.col("s_nationkey").cast("long") * 4 + 1
            )
        )
        .unionAll(
            nation.select(
                F.col("n_nationkey").cast("long") * 4 + 1, F.col("n_regionkey").cast("long") * 4
            )
        )
    )


def connected_components(spark, folder):
    return components.connected_components(_geography(spark, folder))


def mst_cluster_sizes(spark, folder):
    found = components.connected_components(_geography(spark, folder))
    return components.component_sizes(found)


def component_count(spark, folder):
    found = components.connected_components(_geography(spark, folder))
    return components.component_count(found)


def connected_components_chain(spark, folder):
    """A chain in the order of its ids, the longest way for labels to travel."""
    rows = _table(spark, folder, "part")
    chain = rows.select(F.col("p_partkey").alias("u"), (F.col("p_partkey") + 1).alias("v"))
    return components.connected_components(chain)


def euclidean_mst(spark, folder):
    return _rounded(mst.euclidean_mst(_embeddings(spark, folder)), "w")


def euclidean_mst_ties(spark, folder):
    return _rounded(mst.euclidean_mst(_parts(spark, folder)), "w")


def euclidean_mst_plane(spark, folder):
    return _rounded(mst.euclidean_mst(_customers(spark, folder)), "w")


def euclidean_mst_staged(spark, folder):
    """The same tree by small blocks, in stages, with no remainder settled in one task."""
    made = mst.euclidean_mst(_suppliers(spark, folder), BLOCKS_SMALL, one_stage_blocks=1, tail_edges=0)
    return _rounded(made, "w")


# --- dendrograms -------------------------------------------------------------


def single_linkage(spark, folder):
    return _rounded(dendrogram.single_linkage(_embeddings(spark, folder)), "distance")


def single_linkage_parts(spark, folder):
    """Merges of parts of few edges, contracted and replayed apart."""
    return _rounded(dendrogram.single_linkage(_suppliers(spark, folder), leaf_edges=BLOCKS_SMALL), "distance")


def complete_linkage_rounds(spark, folder):
    """Rounds to the end, none of the clusters settled in one task."""
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "complete", tail_clusters=1)
    return _rounded(made, "distance")


def average_linkage_rounds(spark, folder):
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "average", tail_clusters=1)
    return _rounded(made, "distance")


def complete_linkage_split(spark, folder):
    """Clusters larger than a block, cut into pieces."""
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "complete", BLOCKS_SMALL, tail_clusters=1)
    return _rounded(made, "distance")


def complete_linkage(spark, folder):
    return _rounded(linkage.hierarchical_cluster(_embeddings(spark, folder), "complete"), "distance")


def average_linkage(spark, folder):
    return _rounded(linkage.hierarchical_cluster(_embeddings(spark, folder), "average"), "distance")


def single_linkage_ties(spark, folder):
    return _rounded(dendrogram.single_linkage(_parts(spark, folder)), "distance")


def complete_linkage_ties(spark, folder):
    return _rounded(linkage.hierarchical_cluster(_parts(spark, folder), "complete"), "distance")


def dendrogram_top(spark, folder):
    rows = dendrogram.top_merges(linkage.hierarchical_cluster(_embeddings(spark, folder), "complete"))
    return _rounded(rows, "distance")


def slot_tree_ids(spark, folder):
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "average")
    slots = made.select("step", "slot_a", "slot_b", "distance", "new_size")
    return _rounded(dendrogram.slots_to_tree_ids(slots), "distance")


def tree_slot_ids(spark, folder):
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "complete")
    tree = made.select("step", "cluster_a", "cluster_b", "distance", "new_size")
    return _rounded(dendrogram.tree_ids_to_slots(tree), "distance")


def dendrogram_roundtrip(spark, folder):
    made = linkage.hierarchical_cluster(_suppliers(spark, folder), "complete")
    path = Store(spark, "roundtrip").path("merges.csv")
    dendrograms.write_dendrogram(made, path)
    return _rounded(dendrograms.read_dendrogram(spark, path), "distance")


def exchange_roundtrip(spark, folder):
    made = dendrogram.single_linkage(_suppliers(spark, folder))
    path = Store(spark, "exchange").path("merges.csv")
    dendrograms.write_exchange(made, path)
    return _rounded(dendrograms.read_exchange(spark, path), "distance")


def flat_clusters_k(spark, folder):
    made = linkage.hierarchical_cluster(_embeddings(spark, folder), "complete")
    return cut.cut_max_clusters(made, CUT_K)


def flat_clusters_single(spark, folder):
    return cut.cut_max_clusters(dendrogram.single_linkage(_suppliers(spark, folder)), CUT_SUPPLIER_K)


def cluster_label_attach(spark, folder):
    rows = _embeddings(spark, folder)
    flat = cut.cut_max_clusters(linkage.hierarchical_cluster(rows, "average"), CUT_LABELS_K)
    labelled = cut.attach(rows.select("id", "label"), flat)
    return labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("points"))


def compare_heights(spark, folder):
    rows = _suppliers(spark, folder)
    single = dendrogram.single_linkage(rows)
    complete = linkage.hierarchical_cluster(rows, "complete")
    return _rounded(compare.compare_heights(single, complete).drop("message"), "h1", "h2")


def dendrogram_diff(spark, folder):
    """How many rows differ between two block layouts (none), and of how many."""
    rows = _embeddings(spark, folder)
    one = dendrogram.single_linkage(rows)
    two = dendrogram.single_linkage(rows, block_rows=BLOCKS_APART)
    merges = one.agg(F.count(F.lit(1)).alias("merges"))
    different = compare.dendrogram_diff(one, two).agg(F.count(F.lit(1)).alias("different_rows"))
    return different.withColumn("one", F.lit(1)).join(merges.withColumn("one", F.lit(1)), "one").drop("one")


def single_linkage_orders(spark, folder):
    """The largest point set: price (thousands) against day."""
    rows = _table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 1000).alias("price"),
        (F.unix_timestamp("o_orderdate") / 86400).alias("day"),
    )
    return _rounded(dendrogram.single_linkage(points.as_points(rows, "o_orderkey")), "distance")


# --- sources and converters --------------------------------------------------


def read_points_csv(spark, folder):
    path = Store(spark, "points").path("supplier.csv")
    rows = _table(spark, folder, "supplier").select(
        "s_suppkey", "s_acctbal", (F.col("s_acctbal") / 8).alias("half"), F.col("s_nationkey").alias("label")
    )
    convert.write_points(rows, path)
    found = points.read_points(spark, path, id_col="s_suppkey", label_col="label")
    return found.select(
        "id",
        F.col("features")[0].alias("f0"),
        F.round(F.col("features")[1], PLACES).alias("f1"),
        F.size("features").alias("d"),
        "label",
    )


def dataset_profile(spark, folder):
    return points.points_profile(_embeddings(spark, folder))


def table_profile(spark, folder):
    return points.dataset_profile(convert_points(spark, folder))


def label_encode(spark, folder):
    rows = _table(spark, folder, "events").select("event_id", "event_type")
    return convert.encode_labels(rows, "event_type")


def convert_points(spark, folder):
    rows = _table(spark, folder, "part")
    return convert.convert_labelled(rows.select("p_partkey", "p_size", "p_retailprice", "p_type"), ["p_partkey"])


def union_headerless(spark, folder):
    store = Store(spark, "headerless")
    paths = [store.path("supplier.csv"), store.path("customer.csv")]
    for path, name in zip(paths, ("supplier", "customer")):
        c = name[0]
        rows = _table(spark, folder, name).select(f"{c}_acctbal", f"{c}_nationkey")
        rows.write.csv(path, header=False)
    both = convert.union_headerless(spark, paths)
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("points"), F.round(F.sum("x0"), 2).alias("total")
    )


# --- run logs ----------------------------------------------------------------


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines in the shape of a run log: one run per line."""
    rows = _table(spark, folder, "lineitem")
    cuda = F.col("l_linestatus") == "F"
    name = F.when(cuda, "matrix_CUDA").when(F.col("l_discount") < 0.05, "mst_cpu").otherwise("matrix_cpu")
    dataset = (
        F.when(F.col("l_returnflag") == "A", "random_n500")
        .when(F.col("l_returnflag") == "N", "donut3")
        .when(F.col("l_quantity") > 25, "optdigits")
        .otherwise("mixed")
    )
    line = F.col("l_linenumber")
    rows = rows.select(
        name.alias("executable"),
        dataset.alias("dataset"),
        F.when(cuda, F.lit(None).cast("int")).otherwise(line).alias("threads"),
        F.when(cuda, line * 32).alias("block_size"),
        F.pmod("l_orderkey", F.lit(5)).cast("int").alias("rep"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("runtime_ms"),
        F.col("l_shipdate").alias("timestamp"),
        F.lit("single").alias("linkage"),
    )
    digits = F.col("dataset") == "optdigits"
    return rows.select(
        "*",
        classify.implementation_type("executable").alias("implementation_type"),
        classify.is_mst("executable").alias("mst"),
        F.when(digits, 5620).when(F.col("dataset") == "donut3", 999).otherwise(500).cast("long").alias("n"),
        F.when(digits, 64).otherwise(2).cast("int").alias("d"),
        classify.dataset_source("dataset").alias("dataset_source"),
    )


def run_median(spark, folder):
    return _rounded(runlog.median_per_config(_log(spark, folder)), "median_runtime_ms")


def run_median_spread(spark, folder):
    """The same medians by counted values sorted over all partitions."""
    return _rounded(runlog.median_per_config(_log(spark, folder), group_rows=0), "median_runtime_ms")


def run_summary_sizes(spark, folder):
    """A log in which one dataset name has two sizes, so that baselines repeat."""
    log = _log(spark, folder).withColumn("n", F.col("n") + F.pmod("rep", F.lit(2)))
    return _rounded(runlog.summarize(log), "median_runtime_ms", "speedup_vs_1_thread")


def run_summary_files(spark, folder):
    """Two summary files read back and put together."""
    summary = runlog.summarize(_log(spark, folder))
    store = Store(spark, "summaries")
    paths = [store.path("cpu.csv"), store.path("cuda.csv")]
    runlog_files.write_log(summary.where("threads is not null"), paths[0])
    runlog_files.write_log(summary.where("threads is null"), paths[1])
    both = runlog_files.union_summaries(*[runlog_files.read_summary(spark, path) for path in paths])
    return _rounded(both, "median_runtime_ms", "speedup_vs_1_thread")


def run_block_sizes(spark, folder):
    medians = runlog.median_per_config(_log(spark, folder), name="runtime_ms")
    return _rounded(runlog.block_size_series(medians), "runtime_ms")


def run_block_size_pivot(spark, folder):
    rows = _log(spark, folder).where("implementation_type = 'cuda'")
    grid = runlog.pivot_median(rows, column="block_size", columns=[32, 64, 96, 128], order="n")
    return grid.select("dataset", *[F.round(F.col(str(b)), PLACES).alias(f"b{b}") for b in (32, 64, 96, 128)])


def run_speedup_series(spark, folder):
    """Speedup against threads of the shown sets, by executable."""
    rows = runlog.shown_subset(runlog.summarize(_log(spark, folder))).where("threads is not null")
    return _rounded(rows.select("executable", "dataset", "threads", "speedup_vs_1_thread"), "speedup_vs_1_thread")


def implementation_kinds(spark, folder):
    rows = _log(spark, folder)
    return rows.groupBy("executable", "implementation_type", F.col("mst").alias("is_mst")).agg(
        F.count(F.lit(1)).alias("runs")
    )


def run_summary(spark, folder):
    rows = runlog.summarize(_log(spark, folder))
    return _rounded(rows, "median_runtime_ms", "speedup_vs_1_thread")


def run_speedup(spark, folder):
    medians = runlog.median_per_config(_log(spark, folder), name="runtime_ms")
    cpu = F.col("implementation_type") == "cpu"
    rows = runlog.with_speedup(medians, value="runtime_ms", name="speedup", measured=cpu)
    return _rounded(rows, "runtime_ms", "speedup")


def run_pivot(spark, folder):
    rows = _log(spark, folder).where("implementation_type = 'cpu'")
    grid = runlog.pivot_median(rows, columns=[1, 2, 3, 4, 5, 6, 7], order="n")
    return grid.select("dataset", *[F.round(F.col(str(t)), PLACES).alias(f"t{t}") for t in range(1, 8)])


def run_log_union_filter(spark, folder):
    summary = runlog.summarize(_log(spark, folder))
    digits = summary.where(F.col("dataset") == "optdigits").drop("linkage")
    rows = runlog_files.union_summaries(summary.where(F.col("dataset") != "optdigits"), digits)
    rows = runlog.plane_series(rows).unionByName(runlog.speedup_series(rows))
    return _rounded(rows, "median_runtime_ms", "speedup_vs_1_thread")


def run_series(spark, folder):
    medians = runlog.median_per_config(_log(spark, folder), name="runtime_ms")
    rows = runlog.runtime_series(runlog.shown_subset(medians))
    return _rounded(rows, "runtime_ms")


def dataset_sizes(spark, folder):
    return runlog.dataset_sizes(_log(spark, folder))


def log_names(spark, folder):
    return runlog_files.names(_log(spark, folder), "executable")


def run_log_roundtrip(spark, folder):
    log = _log(spark, folder)
    blank = F.lit(None).cast("string")
    full = log.withColumns(
        {
            "has_labels": F.col("dataset") != "random_n500",
            "error": F.when(F.col("runtime_ms").isNull(), "Timeout"),
            "host": blank,
            "platform": blank,
            "cpu": blank,
            "hardware_note": blank,
            "command": classify.command_line("executable", "dataset", F.lit("--linkage"), "linkage"),
        }
    )
    columns = [c.split()[0] for c in runlog_files.RUN_LOG.split(", ")]
    path = Store(spark, "run-log").path("log.csv")
    runlog_files.write_log(full.select(columns), path)
    back = runlog_files.read_run_log(spark, path)
    return back.groupBy("executable", "dataset", "threads", "block_size", "error", "command").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count("runtime_ms").alias("timed"),
        F.max("timestamp").alias("latest"),
        F.max("runtime_ms").alias("longest"),
    )


def run_log_text(spark, folder):
    rows = _table(spark, folder, "documents")
    return rows.select(
        "doc_id",
        classify.short_error("text").alias("error"),
        classify.command_line("lang", F.lit("--source"), "source").alias("command"),
        classify.missing_as_empty(F.when(F.col("n_chars") > 500, F.col("n_chars"))).alias("size"),
    )


def event_stamp(spark, folder):
    return _table(spark, folder, "events").select("event_id", classify.stamp("ts").alias("at"))


def extract_runtime(spark, folder):
    rows = _table(spark, folder, "events")
    odd = F.pmod("user_id", F.lit(3)) == 0
    text = F.when(odd, F.concat(F.lit("failed on "), "props")).otherwise(
        F.concat(F.lit("Loaded points\nruntime_ms:  "), F.col("value").cast("string"), F.lit("\ndone"))
    )
    return rows.select("event_id", classify.parse_runtime(text).alias("runtime_ms"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        pairwise_distance, distance_column, closest_pair, nearest_neighbor, nearest_neighbor_ties,
        lance_williams_update, connected_components, mst_cluster_sizes, component_count,
        euclidean_mst, euclidean_mst_ties, euclidean_mst_plane, single_linkage, complete_linkage,
        average_linkage, euclidean_mst_staged, single_linkage_parts, complete_linkage_rounds,
        average_linkage_rounds, complete_linkage_split, connected_components_chain, single_linkage_orders, single_linkage_ties, complete_linkage_ties, dendrogram_top, slot_tree_ids,
        tree_slot_ids, dendrogram_roundtrip, exchange_roundtrip, flat_clusters_k,
        flat_clusters_single, cluster_label_attach, compare_heights, dendrogram_diff,
        read_points_csv, dataset_profile, table_profile, label_encode, convert_points,
        union_headerless, run_median, run_summary, run_speedup, run_pivot, run_log_union_filter,
        run_median_spread, run_summary_sizes, run_summary_files, run_block_sizes, run_block_size_pivot,
        run_speedup_series, implementation_kinds, run_series, dataset_sizes, log_names, run_log_roundtrip, run_log_text, event_stamp,
        extract_runtime,
    )
}
