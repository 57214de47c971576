"""Registry: query key -> callable ``(spark, sf_dir) -> DataFrame``.

Registered outputs round doubles to 6 digits (both here and in the SQL oracles) so
that results that differ only in floating-point summation order compare equal.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import features as feat
from quarry.operators import graph
from quarry.operators import telemetry as tm
from quarry.operators import text as txt
from quarry.operators import training as tr
from quarry.operators.scoring import (LinearModel, class_mean_model, class_mean_rows, load_linear, parameter_count, score_by_class_rows,
                                      score_linear)
from quarry.operators.indexing import assign_batches, assign_split, equal_random_buckets, global_index
from quarry.operators.sorting import (ordered_position, read_lines_in_order, sort_by_keys, sort_csv,
                                      sort_to_ordered_partitions, with_sorted_position)
from quarry.plans import fixtures as fx
from quarry.session import scratch_path
from quarry.sinks import append_log, save_model, write_csv, write_predictions, write_rank_text, write_report
from quarry.sources import drop_comments, load_model, parse_edges, read_edge_lines, read_table_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DAMPING = 0.85
EPOCHS = 10


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r9(c) -> "F.Column":
    """Gradients at zero weights are 1/C - k/(batch * ranks): at most 8 decimals, so a
    6-digit rounding can sit exactly on a tie; 9 digits cannot."""
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


# ------------------------------------------------------------------------ graph: steps

@query("initial_ranks")
def q_initial_ranks(spark, sf):
    return graph.initial_ranks(fx.g_chain(spark, sf))


@query("edge_rank_join")
def q_edge_rank_join(spark, sf):
    """Edges joined to the initial ranks by source, one row per edge (duplicates kept)."""
    edges = fx.g_chain(spark, sf)
    return graph.join_ranks(edges, graph.initial_ranks(edges)).select("src", "dst", "rank")


@query("adjacency")
def q_adjacency(spark, sf):
    return graph.adjacency(fx.g_chain(spark, sf))


def _first_pass(spark, sf) -> DataFrame:
    """Every edge with its source's initial rank and out-degree."""
    edges = fx.g_chain(spark, sf)
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    return graph.join_ranks(edges, graph.initial_ranks(edges).join(degree, "src"))


@query("contributions")
def q_contributions(spark, sf):
    """First-pass contribution of every edge: rank / out-degree of its source."""
    return graph.contributions(_first_pass(spark, sf)).select("src", "dst", r6("contribution").alias("contribution"))


@query("damped_sum")
def q_damped_sum(spark, sf):
    """One pass: per destination (1 - d) + d * sum of contributions."""
    return _ranks(graph.damped_sum(graph.contributions(_first_pass(spark, sf)), DAMPING, out_key="id"))


@query("map_values")
def q_map_values(spark, sf):
    """First pass as two steps: sum of contributions per destination, then the damping
    applied to the value only."""
    sums = graph.contributions(_first_pass(spark, sf)).groupBy(F.col("dst").alias("id")).agg(
        F.sum("contribution").alias("rank"))
    damped = graph.map_values(sums, lambda v: F.lit(1.0 - DAMPING) + F.lit(DAMPING) * v)
    return _ranks(damped)


@query("char_contributions")
def q_char_contributions(spark, sf):
    c = graph.char_contributions(fx.g_chars(spark, sf))
    return c.select(F.col("dst").alias("ch"), r6("contribution").alias("contribution"))


# ------------------------------------------------------------------------ graph: jobs

def _ranks(df: DataFrame) -> DataFrame:
    return df.select("id", r6("rank").alias("rank"))


@query("pagerank")
def q_pagerank(spark, sf):
    return _ranks(graph.pagerank(fx.g_chain(spark, sf), DAMPING, EPOCHS, persist=False))


@query("pagerank_ragged")
def q_pagerank_ragged(spark, sf):
    return _ranks(graph.pagerank(fx.g_ragged(spark, sf), DAMPING, EPOCHS))


@query("pagerank_partitioned")
def q_pagerank_partitioned(spark, sf):
    return _ranks(graph.pagerank(fx.g_chain(spark, sf), DAMPING, EPOCHS, num_partitions=20,
                                 persist=False))


@query("pagerank_persisted")
def q_pagerank_persisted(spark, sf):
    return _ranks(graph.pagerank(fx.g_chain(spark, sf), DAMPING, EPOCHS, persist=True))


@query("pagerank_bucket_sample")
def q_pagerank_bucket_sample(spark, sf):
    edges = fx.g_chain(spark, sf)
    bucketed = equal_random_buckets(edges, n=20, key=["src", "dst"], seed=42)
    return _ranks(graph.pagerank(bucketed.where(F.col("bucket") == 0).select("src", "dst"),
                                 DAMPING, EPOCHS))


@query("pagerank_as_written")
def q_pagerank_as_written(spark, sf):
    return _ranks(graph.pagerank_as_written(fx.g_chars(spark, sf), DAMPING))


@query("equal_random_buckets")
def q_equal_random_buckets(spark, sf):
    rows = fx.b_rows(spark, sf)
    return equal_random_buckets(rows, n=20, key="event_id", seed=42).select("event_id", "bucket")


# ------------------------------------------------------------------ indexing / batches

@query("dataset_split")
def q_dataset_split(spark, sf):
    return assign_split(fx.b_rows(spark, sf), "event_id", (80, 10, 10), seed=42).select("event_id", "split")


@query("assign_batches")
def q_assign_batches(spark, sf):
    b = assign_batches(fx.b_rows(spark, sf).select("event_id"), "event_id", batch_size=64,
                       shuffle=True, seed=42, epoch=1, world_size=4)
    return b.select("event_id", "epoch", "rank", "step")


# ----------------------------------------------------------------- sources and sorting

def _t_sort_csv(spark, sf) -> str:
    path = scratch_path(spark, "t_sort_csv")
    write_csv(fx.t_sort(spark, sf), path)
    return path


@query("csv_scan")
def q_csv_scan(spark, sf):
    return read_table_csv(spark, _t_sort_csv(spark, sf))


@query("sort_by_keys")
def q_sort_by_keys(spark, sf):
    """The sort made visible: each row's place in the sorted table's partition order."""
    return ordered_position(sort_by_keys(read_table_csv(spark, _t_sort_csv(spark, sf)), fx.SORT_KEYS))


@query("sort_typed")
def q_sort_typed(spark, sf):
    """The same file read with a schema: numbers sort as numbers."""
    schema = "cca2 string, timestamp int, o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    return with_sorted_position(read_table_csv(spark, _t_sort_csv(spark, sf), schema), ["timestamp", "o_orderkey"])


@query("sort_single_partition")
def q_sort_single_partition(spark, sf):
    """Re-aimed: the sorted result as globally ordered range partitions (the single
    sorted sequence, without one task holding every row); ``pos`` is the position in
    partition order, which must equal the sorted position."""
    ordered = sort_to_ordered_partitions(fx.t_sort(spark, sf), fx.SORT_KEYS)
    return ordered_position(ordered)


@query("sort_csv_job")
def q_sort_csv_job(spark, sf):
    """CSV -> sort -> CSV part files in global order; read back in file order."""
    dst = scratch_path(spark, "sorted_csv")
    sort_csv(spark, _t_sort_csv(spark, sf), dst, fx.SORT_KEYS)
    back = read_table_csv(spark, dst).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_mid"))
    return global_index(back, ["_file", "_mid"], pos="pos").drop("_file", "_mid")


@query("csv_sink")
def q_csv_sink(spark, sf):
    path = scratch_path(spark, "csv_sink")
    write_csv(fx.t_sort(spark, sf), path, sort_keys=fx.SORT_KEYS)
    back = read_table_csv(spark, path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_mid"))
    return global_index(back, ["_file", "_mid"], pos="pos").drop("_file", "_mid")


def _g_text_dir(spark, sf) -> str:
    path = scratch_path(spark, "g_text")
    fx.g_text_lines(spark, sf).write.text(path)
    return path


@query("text_edge_scan")
def q_text_edge_scan(spark, sf):
    return read_edge_lines(spark, _g_text_dir(spark, sf))


@query("comment_filter")
def q_comment_filter(spark, sf):
    return drop_comments(read_edge_lines(spark, _g_text_dir(spark, sf)), "#")


@query("edge_parse")
def q_edge_parse(spark, sf):
    return parse_edges(read_edge_lines(spark, _g_text_dir(spark, sf)), mode="dropmalformed")


@query("tuple_text_sink")
def q_tuple_text_sink(spark, sf):
    """The written ``('key', value)`` lines, ranks rounded to 6 digits before writing."""
    ranks = _ranks(graph.pagerank(fx.g_chain(spark, sf), DAMPING, EPOCHS))
    return spark.read.text(write_rank_text(ranks, scratch_path(spark, "ranks_out")))


# --------------------------------------------------------------- scoring / evaluation

def _x_model(spark, sf) -> LinearModel:
    x = fx.x_vec(spark, sf)
    return load_linear(class_mean_model(x.where(F.col("split") == "train")))


def _x_scored(spark, sf, split: str | None = "validation", with_label: bool = True) -> DataFrame:
    """Class-mean model scored on one split, or on the whole table without one; batch =
    position (by vec_id) div 16."""
    x = fx.x_vec(spark, sf)
    model = _x_model(spark, sf)
    target = (x.where(F.col("split") == split) if split else x).drop("split")
    batched = global_index(target, ["vec_id"], pos="pos").withColumn(
        "batch", F.floor(F.col("pos") / 16).cast("int"))
    return score_linear(batched, model, label="label" if with_label else None)


@query("linear_logits")
def q_linear_logits(spark, sf):
    s = _x_scored(spark, sf, split=None)
    return s.select("vec_id", F.posexplode("logits").alias("class", "logit")).select(
        "vec_id", "class", r6("logit").alias("logit"))


@query("log_softmax")
def q_log_softmax(spark, sf):
    s = _x_scored(spark, sf, split=None)
    return s.select("vec_id", F.posexplode("log_probs").alias("class", "log_prob")).select(
        "vec_id", "class", r6("log_prob").alias("log_prob"))


@query("argmax_class")
def q_argmax_class(spark, sf):
    return _x_scored(spark, sf, split=None).select("vec_id", "label", "pred")


@query("cross_entropy")
def q_cross_entropy(spark, sf):
    return _x_scored(spark, sf, split=None).select("vec_id", r6("loss").alias("loss"))


@query("score_join")
def q_score_join(spark, sf):
    return _x_scored(spark, sf, split=None, with_label=False).select("vec_id", "pred")


@query("batch_score")
def q_batch_score(spark, sf):
    s = _x_scored(spark, sf)
    return s.select("vec_id", "batch", "label", "pred", r6("loss").alias("loss"))


@query("score_class_rows")
def q_score_class_rows(spark, sf):
    """``batch_score`` with the model as a table of class rows instead of plan literals."""
    x = fx.x_vec(spark, sf)
    held = global_index(x.where(F.col("split") == "validation").drop("split"), ["vec_id"], pos="pos").withColumn("batch", F.floor(F.col("pos") / 16).cast("int"))
    model = class_mean_rows(x.where(F.col("split") == "train"))
    s = score_by_class_rows(held, model, keep=("vec_id", "batch", "label"))
    return s.select("vec_id", "batch", "label", "pred", r6("loss").alias("loss"))


@query("accuracy")
def q_accuracy(spark, sf):
    return ev.accuracy(_x_scored(spark, sf)).select(r6("accuracy").alias("accuracy"))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return ev.confusion_matrix(_x_scored(spark, sf))


@query("classification_report")
def q_classification_report(spark, sf):
    rep = ev.classification_report(_x_scored(spark, sf))
    return rep.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1_score").alias("f1_score"), "support")


@query("mean_of_batch_loss")
def q_mean_of_batch_loss(spark, sf):
    return ev.mean_of_batch_loss(_x_scored(spark, sf), "batch").select(r6("loss").alias("loss"))


@query("eval_report")
def q_eval_report(spark, sf):
    rep = ev.eval_report(_x_scored(spark, sf), "batch")
    return rep.select("section", F.concat_ws("|", "label", "other").alias("label"), "metric", r6("value").alias("value"))


@query("parameter_count")
def q_parameter_count(spark, sf):
    x = fx.x_vec(spark, sf)
    return parameter_count(class_mean_model(x.where(F.col("split") == "train")))


@query("report_sink")
def q_report_sink(spark, sf):
    """The written image-form report, line by line."""
    path = scratch_path(spark, "report")
    write_report(ev.eval_report(_x_scored(spark, sf), "batch"), path, checkpoint="class-mean")
    return read_lines_in_order(spark, path)


@query("text_report_sink")
def q_text_report_sink(spark, sf):
    """The written text-form report of the text classifier on the held-out validation split, in
    batches of 20 by ``idx``."""
    held = fx.s_sent(spark, sf).where(F.col("split") == "validation").select("idx", "sentence", "label")
    scored = _text_scored(spark, sf, global_index(held, ["idx"], pos="pos")).withColumn("batch", F.floor(F.col("pos") / TEXT_BATCH))
    path = scratch_path(spark, "text_report")
    write_report(ev.eval_report(scored, "batch", names=["negative", "positive"]), path, "bag-of-ids", "text", tm.eval_timing(fx.l_tele(spark, sf)))
    return read_lines_in_order(spark, path)


# ------------------------------------------------------------------------- telemetry

def _tele_cols(df: DataFrame) -> DataFrame:
    return df.select("epoch", "batch_idx", "event_id", r6("loss").alias("loss"),
                     r6("accuracy").alias("accuracy"), r6("duration").alias("duration"))


def _epochs_out(df: DataFrame) -> DataFrame:
    return df.select("epoch", r6("train_loss").alias("train_loss"), r6("train_accuracy").alias("train_accuracy"),
                     r6("avg_batch_duration").alias("avg_batch_duration"),
                     r6("epoch_duration").alias("epoch_duration"), "batches")


@query("telemetry_sample")
def q_telemetry_sample(spark, sf):
    return _tele_cols(tm.sample_batches(fx.l_tele(spark, sf), 20))


@query("telemetry_cap")
def q_telemetry_cap(spark, sf):
    return _tele_cols(tm.cap_batches(fx.l_tele(spark, sf), 41))


@query("epoch_summary_skip_first")
def q_epoch_summary_skip_first(spark, sf):
    return _epochs_out(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=True))


@query("epoch_summary_all")
def q_epoch_summary_all(spark, sf):
    return _epochs_out(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=False))


@query("run_summary")
def q_run_summary(spark, sf):
    r = tm.run_summary(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=False))
    return r.select(r6("avg_train_loss").alias("avg_train_loss"), r6("avg_train_accuracy").alias("avg_train_accuracy"),
                    r6("avg_epoch_duration").alias("avg_epoch_duration"),
                    r6("avg_batch_duration").alias("avg_batch_duration"), "epochs")


@query("eval_timing")
def q_eval_timing(spark, sf):
    t = tm.eval_timing(fx.l_tele(spark, sf))
    return t.select(r6("avg_batch_duration").alias("avg_batch_duration"), r6("duration").alias("duration"), "batches")


@query("format_log_line")
def q_format_log_line(spark, sf):
    return tm.format_epoch_log(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=True))


@query("format_batch_log")
def q_format_batch_log(spark, sf):
    return tm.format_batch_log(fx.l_tele(spark, sf))


@query("format_text_batch_log")
def q_format_text_batch_log(spark, sf):
    return tm.format_text_batch_log(fx.l_tele(spark, sf))


@query("format_text_epoch_log")
def q_format_text_epoch_log(spark, sf):
    return tm.format_text_epoch_log(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=False))


@query("format_text_run_log")
def q_format_text_run_log(spark, sf):
    return tm.format_text_run_log(tm.run_summary(tm.epoch_summary(fx.l_tele(spark, sf), skip_first=False)))


@query("train_log_sink")
def q_train_log_sink(spark, sf):
    """Two runs appended to the logs of four ranks: every line with its rank and how often it
    stands there."""
    path = scratch_path(spark, "train_log")
    tele = fx.l_tele(spark, sf).withColumn("rank", F.pmod("event_id", F.lit(4)).cast("int"))
    for run in ("first", "second"):
        append_log(tm.train_log(tele, checkpoint=f"/checkpoints/{run}"), path)
    return spark.read.text(path).groupBy("rank", "value").agg(F.count(F.lit(1)).alias("n"))


@query("text_train_log_sink")
def q_text_train_log_sink(spark, sf):
    """The written log of a text training run, line by line."""
    path = scratch_path(spark, "text_train_log")
    append_log(tm.text_train_log(fx.l_tele(spark, sf)), path)
    return read_lines_in_order(spark, path)


@query("warmup_linear_lr")
def q_warmup_linear_lr(spark, sf):
    n_train = fx.s_sent(spark, sf).where(F.col("split") == "train").count()
    total = 3 * -(-n_train // 20)
    return tm.lr_schedule(spark, total, warmup=100, base=5e-5).select(
        "step", F.round("lr", 12).alias("lr"))


# -------------------------------------------------------------------------- features

@query("scale_pixels")
def q_scale_pixels(spark, sf):
    cells = feat.image_cells(feat.scale_pixels(fx.x_img(spark, sf)), order="chw")
    return cells.select("id", "h", "w", "c", r6("v").alias("v"))


@query("normalize_channels")
def q_normalize_channels(spark, sf):
    norm = feat.normalize_channels(feat.scale_pixels(fx.x_img(spark, sf)))
    return feat.image_cells(norm, order="chw").select("id", "h", "w", "c", r6("v").alias("v"))


@query("random_crop")
def q_random_crop(spark, sf):
    return feat.image_cells(feat.random_crop(fx.x_img(spark, sf), pad=1, size=8, seed=42, epoch=1))


@query("random_flip")
def q_random_flip(spark, sf):
    return feat.image_cells(feat.random_flip(fx.x_img(spark, sf), p=0.5, seed=42, epoch=1))


# ------------------------------------------------------------------------------ text

MAX_LENGTH = 512
TEXT_BATCH = 20
#: a public tokenizer file; its units don't span white space
TOKENIZER = os.environ.get("QUARRY_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")


def _vocab(spark, docs) -> DataFrame:
    return txt.build_vocab(docs).checkpoint(eager=True)  # reused by every encoding


@query("build_vocab")
def q_build_vocab(spark, sf):
    return txt.build_vocab(fx.s_docs(spark, sf))


def _encoded(enc: DataFrame, *first) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return enc.select(*first, "window", F.array_join("input_ids", " ").alias("input_ids"), total("attention_mask").alias("mask_len"),
                      total("token_type_ids").alias("type_sum"), F.size("input_ids").alias("length"))


@query("encode_text")
def q_encode_text(spark, sf):
    """Every document as windows of 512 ids."""
    docs = fx.s_docs(spark, sf)
    return _encoded(txt.encode_text(docs, _vocab(spark, docs), MAX_LENGTH, keep=("idx",)), "idx")


@query("drop_columns")
def q_drop_columns(spark, sf):
    """Training-mode encoding: ``idx`` and ``sentence`` are dropped."""
    docs = fx.s_docs(spark, sf)
    return _encoded(txt.encode_text(docs, _vocab(spark, docs), MAX_LENGTH, keep=("label",)), F.col("label").cast("string").alias("label"))


@query("encode_subwords")
def q_encode_subwords(spark, sf):
    """Every document as windows of 512 sub-word ids of a public tokenizer, and what they spell: the
    round trip gives each text in lower case; white space is the tokenizer's own and left out."""
    encoded = txt.encode_subwords(fx.s_docs(spark, sf), TOKENIZER, MAX_LENGTH, keep=("idx",))
    back = txt.decode_subwords(encoded, TOKENIZER)
    return back.select("idx", F.regexp_replace("text", r"\s+", "").alias("spelled"))


def _text_scored(spark, sf, docs: DataFrame | None = None) -> DataFrame:
    """A classifier of the labelled train split applied to every document, or to ``docs``."""
    every = fx.s_docs(spark, sf)
    texts = fx.table(spark, sf, "documents")  # no label is needed to count the words
    id_space = texts.select(F.explode(txt.word_hashes(F.col("text")))).distinct().count() + txt.FIRST_WORD_ID
    model = txt.fit_words(fx.s_sent(spark, sf).where(F.col("split") == "train"), id_space)
    docs = every if docs is None else docs
    return txt.score_words(docs, model, keep=docs.columns, label="label")


@query("project_predictions")
def q_project_predictions(spark, sf):
    table = txt.predictions_table(_text_scored(spark, sf), "validation")
    return table.withColumn("GroundTruth", F.col("GroundTruth").cast("string"))  # null without a label


@query("predictions_sink")
def q_predictions_sink(spark, sf):
    predictions = txt.predictions_table(_text_scored(spark, sf), "test")
    directory = scratch_path(spark, "predictions")
    path = write_predictions(predictions, directory, order_col="idx")
    back = (spark.read.option("header", "true").option("multiLine", "true").csv(path)
            .select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_mid")))
    return global_index(back, ["_file", "_mid"], pos="pos").drop("_file", "_mid")


# -------------------------------------------------------------------------- training

WORLD = 4
RANK_BATCH = 64


def _x_train(spark, sf) -> DataFrame:
    return fx.x_vec(spark, sf).where(F.col("split") == "train").drop("split")


def _x_batched(spark, sf, epoch: int = 1, whole: bool = True) -> DataFrame:
    rows = fx.x_vec(spark, sf).drop("split") if whole else _x_train(spark, sf)
    return assign_batches(rows, "vec_id", RANK_BATCH, shuffle=True, seed=42,
                          epoch=epoch, world_size=WORLD)


def _x_shape(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.max("label"), F.max(F.size("features"))).first()
    return int(row[0]) + 1, int(row[1])


def _zero_parts(spark, sf) -> DataFrame:
    batched = _x_batched(spark, sf)
    classes, dim = _x_shape(batched)
    return tr.partial_gradients(batched, tr.zero_model(classes, dim))


@query("collate_batches")
def q_collate_batches(spark, sf):
    c = tr.collate_batches(_x_batched(spark, sf), key="vec_id")
    return c.select("epoch", "rank", "step", F.size("ids").alias("size"),
                    F.element_at("ids", 1).alias("first_id"), F.element_at("ids", -1).alias("last_id"),
                    F.aggregate("labels", F.lit(0).cast("bigint"), lambda a, y: a + y).alias("label_sum"))


@query("uncollate_batches")
def q_uncollate_batches(spark, sf):
    """Every row back from records of at most 16 kB, beside its own batch."""
    c = tr.collate_batches(_x_batched(spark, sf), key="vec_id", record_bytes=16 << 10)
    rows = tr.uncollate_batches(c, {"ids": "vec_id", "labels": "label", "features": "features"})
    return rows.select("epoch", "rank", "step", "vec_id", "label", F.size("features").alias("n_features"),
                       r6(F.get("features", F.lit(0))).alias("first_feature"))


@query("combine_gather_mean")
def q_combine_gather_mean(spark, sf):
    g = tr.combine_gradients(_zero_parts(spark, sf), "gather_mean")
    return g.select("step", "j", r9("grad").alias("grad"))


@query("combine_allreduce")
def q_combine_allreduce(spark, sf):
    g = tr.combine_gradients(_zero_parts(spark, sf), "allreduce", WORLD)
    return g.select("step", "j", r9("grad").alias("grad"))


@query("combine_equivalence")
def q_combine_equivalence(spark, sf):
    return tr.combine_check(_zero_parts(spark, sf), WORLD).select(
        F.round("max_abs_diff", 9).alias("max_abs_diff"))


@query("softmax_gradient_step")
def q_softmax_gradient_step(spark, sf):
    """One data-parallel SGD step from zero weights on step 0 (first step: v = g)."""
    batched = _x_batched(spark, sf, whole=False)
    classes, dim = _x_shape(batched)
    model = tr.zero_model(classes, dim)
    parts = tr.partial_gradients(batched.where(F.col("step") == 0), model)
    g = tr.combine_gradients(parts, "gather_mean")
    opt = tr.SGD()
    # zero weights: weight decay adds nothing and the momentum buffer starts at g
    return g.select("j", r9("grad").alias("grad"), r9(F.lit(-opt.lr) * F.col("grad")).alias("weight"))


def _theta_frame(spark, state: tr.TrainState) -> DataFrame:
    theta = state.theta
    return spark.createDataFrame([(int(j), float(v)) for j, v in enumerate(theta)], "j int, value double") \
        .select("j", r6("value").alias("value"))


def _fit(spark, sf, optimizer_factory, epochs: int = 1, state=None, on_epoch_end=None):
    train_df = _x_train(spark, sf)
    classes, dim = _x_shape(train_df)
    opt = optimizer_factory(train_df)
    if state is None:
        model = tr.zero_model(classes, dim)
        state = tr.TrainState(model, opt.init(np.concatenate([model.weight.ravel(), model.bias])))
    return tr.train(train_df, state, opt, epochs=epochs, batch_size=RANK_BATCH, world_size=WORLD,
                    max_batches=None, seed=42, key="vec_id", on_epoch_end=on_epoch_end), opt


def _adamw(train_df):
    n = train_df.count()
    steps = -(-(-(-n // WORLD)) // RANK_BATCH)
    return tr.AdamW(lr=5e-3, warmup=2, total_steps=3 * steps)


@query("train_sgd")
def q_train_sgd(spark, sf):
    state, _ = _fit(spark, sf, lambda df: tr.SGD(), epochs=1)
    return _theta_frame(spark, state)


@query("train_sgd_full_batch")
def q_train_sgd_full_batch(spark, sf):
    """Three full-batch SGD steps (momentum 0.9, weight decay 1e-4, lr 0.1) on one rank."""
    train_df = _x_train(spark, sf)
    classes, dim = _x_shape(train_df)
    model = tr.zero_model(classes, dim)
    state = tr.TrainState(model, tr.SGD().init(None))
    state = tr.train(train_df, state, tr.SGD(), epochs=3, batch_size=1 << 40, world_size=1,
                     max_batches=None, seed=42, key="vec_id")
    return _theta_frame(spark, state)


@query("train_adamw")
def q_train_adamw(spark, sf):
    state, _ = _fit(spark, sf, _adamw, epochs=3)
    return _theta_frame(spark, state)


@query("checkpoint_sink")
def q_checkpoint_sink(spark, sf):
    path = scratch_path(spark, "checkpoints")
    _fit(spark, sf, lambda df: tr.SGD(), epochs=2,
         on_epoch_end=lambda st: save_model(tr.state_frame(spark, st), path, st.epoch))
    back = spark.read.parquet(path)
    return back.select("version", "name", "slot", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"),
                       F.size("values").alias("n_values"), "step", "epoch", r6("loss").alias("loss"))


@query("checkpoint_load")
def q_checkpoint_load(spark, sf):
    path = scratch_path(spark, "checkpoints")
    _fit(spark, sf, lambda df: tr.SGD(), epochs=1,
         on_epoch_end=lambda st: save_model(tr.state_frame(spark, st), path, st.epoch))
    state = tr.state_from_frame(load_model(spark, path, 1), tr.SGD())
    scored = score_linear(fx.x_vec(spark, sf).where(F.col("split") == "validation"), state.model)
    return scored.select("vec_id", "label", "pred", r6("loss").alias("loss"))


@query("train_resume")
def q_train_resume(spark, sf):
    """Two epochs straight vs one epoch, save, load, one more epoch: largest difference."""
    straight, _ = _fit(spark, sf, lambda df: tr.SGD(), epochs=2)
    path = scratch_path(spark, "resume")
    _fit(spark, sf, lambda df: tr.SGD(), epochs=1,
         on_epoch_end=lambda st: save_model(tr.state_frame(spark, st), path, st.epoch))
    loaded = tr.state_from_frame(load_model(spark, path, 1), tr.SGD())
    resumed, _ = _fit(spark, sf, lambda df: tr.SGD(), epochs=1, state=loaded)
    diff = float(np.max(np.abs(straight.theta - resumed.theta)))
    return (_theta_frame(spark, resumed).withColumnRenamed("value", "resumed")
            .withColumn("max_abs_diff_to_straight", F.lit(round(diff, 9))))
