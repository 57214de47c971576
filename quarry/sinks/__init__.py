"""Sinks: CSV, rank text, predictions, report text, training logs, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.decimals import printed
from quarry.operators.indexing import spread_ties


def write_csv(df: DataFrame, path: str, single: bool = False, sort_keys: Sequence[str] | None = None,
              mode: str = "errorifexists", num_partitions: int | None = None) -> None:
    """Header CSV.

    ``single``: one part file (one writer task -- for results that must be one file).
    With ``sort_keys`` and not ``single``: range-partitioned, sorted part files, so
    reading the files in name order gives the global order without one big task.
    """
    out = df
    if sort_keys:
        if single:
            out = out.repartition(1).sortWithinPartitions(*sort_keys)
        else:
            n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            order = spread_ties(df, [F.col(k) for k in sort_keys])
            out = out.repartitionByRange(n, *order).sortWithinPartitions(*order)
    elif single:
        out = out.repartition(1)
    _csv_writer(out.write.mode(mode)).csv(path)


def _csv_writer(writer):
    # keep values exactly as they are (the CSV writer trims blanks by default)
    return (writer.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false"))


def _python_text(c: Column) -> Column:
    """A string as Python's ``repr`` writes it: single quotes, or double ones if the text has
    single ones only; backslash, quote and unprintable Latin-1 characters escaped."""
    quote = F.when(c.contains("'") & ~c.contains('"'), F.lit('"')).otherwise(F.lit("'"))
    named = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}

    def escaped(ch: Column) -> Column:
        code = F.ascii(ch)
        out = F.when((code < 32) | ((code >= 127) & (code <= 160)) | (code == 173), F.format_string("\\x%02x", code)).otherwise(ch)
        for raw, text in named.items():
            out = F.when(ch == raw, F.lit(text)).otherwise(out)
        return F.when((ch == "'") & (quote == "'"), F.lit("\\'")).otherwise(out)

    body = F.array_join(F.transform(F.filter(F.split(c, ""), lambda ch: ch != ""), escaped), "")
    return F.concat(quote, body, quote)


def _python_float(c: Column) -> Column:
    """A double as Python's ``repr`` writes it: the shortest digits, an exponent only below
    1e-4 and from 1e16."""
    text = c.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)E", 1)
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", "")
    whole = F.concat(F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), "0"))
    plain = F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)).otherwise(
        F.concat(F.substring(whole, F.lit(1), exponent + 1), F.lit("."),
                 F.when(F.length(whole) > exponent + 1, F.substring(whole, exponent + 2, F.length(whole))).otherwise("0")))
    scientific = F.concat(F.regexp_replace(mantissa, r"\.0$", ""), F.when(exponent < 0, "e-").otherwise("e+"),
                          F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"))
    return (F.when(text.isin("NaN"), "nan").when(text == "Infinity", "inf").when(text == "-Infinity", "-inf")
            .when(exponent.isNull(), text)
            .otherwise(F.concat(sign, F.when((exponent >= -4) & (exponent < 16), plain).otherwise(scientific))))


def rank_lines(ranks: DataFrame, key: str = "id", value: str = "rank") -> DataFrame:
    """``('key', value)`` tuple text, one line per row, as Python prints a (str, float) tuple;
    a null is ``None``."""
    name = F.coalesce(_python_text(F.col(key).cast("string")), F.lit("None"))
    number = F.coalesce(_python_float(F.col(value).cast("double")), F.lit("None"))
    return ranks.select(F.concat(F.lit("("), name, F.lit(", "), number, F.lit(")")).alias("value"))


def write_rank_text(ranks: DataFrame, directory: str, key: str = "id", value: str = "rank",
                    mode: str = "errorifexists") -> str:
    """Write tuple text under ``<directory>/wiki.txt``; fails if it exists (default)."""
    path = directory.rstrip("/") + "/wiki.txt"
    rank_lines(ranks, key, value).write.mode(mode).text(path)
    return path


def write_predictions(predictions: DataFrame, directory: str, order_col: str | None = None,
                      mode: str = "errorifexists") -> str:
    """``<directory>/output.csv`` with a header; rows in input order when ``order_col``
    (range-partitioned, sorted part files; the column itself is not written)."""
    path = directory.rstrip("/") + "/output.csv"
    if order_col:
        order = spread_ties(predictions, [F.col(order_col)])
        out = predictions.repartitionByRange(*order).sortWithinPartitions(*order).drop(order_col)
    else:
        out = predictions
    _csv_writer(out.write.mode(mode)).csv(path)
    return path


def write_lines(lines: DataFrame, path: str, order_col: str = "line_no", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> None:
    """Text lines in ``order_col`` order: range-partitioned, sorted part files, so their
    concatenation in name order is the text and no task has to hold it all (a small text
    is one file)."""
    cols = list(partition_by or [])
    out = lines.repartitionByRange(*cols, order_col).sortWithinPartitions(*cols, order_col)
    writer = out.select(*cols, "value").write.mode(mode)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.text(path)


def append_log(lines: DataFrame, path: str) -> None:
    """Add a run's lines to the log under ``path``; earlier runs stay. With a ``rank`` column
    each rank has its own log ``rank=<r>``."""
    write_lines(lines, path, mode="append", partition_by=["rank"] if "rank" in lines.columns else None)


def save_model(model: DataFrame, path: str, version: int) -> None:
    """Parameters / optimizer slots of one version into ``path/version=<v>/``; saving a
    version again replaces only that version's folder."""
    (model.withColumn("version", F.lit(version).cast("int")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))


def report_lines(report: DataFrame, checkpoint: str, form: str = "image", timing: DataFrame | None = None) -> DataFrame:
    """Text of an evaluation report from the tidy ``eval_report`` table, ``(line_no, value)``:
    header, loss and accuracy, per-label table, confusion matrix, separator.

    ``form="image"`` and ``form="text"`` differ in the two head lines; the text form also
    prints ``timing`` (one row: avg_batch_duration, duration).
    """
    r = report
    spark = r.sparkSession
    summary = r.where("section = 'summary'").groupBy().pivot("metric", ["loss", "accuracy"]).agg(F.first("value"))
    if form == "image":
        head = [F.lit(f"Metrics for the checkpoint: {checkpoint}"), printed("Test Loss: %.3f, Test Accuracy: %.3f", "loss", "accuracy")]
    elif form == "text":
        if timing is None:
            raise ValueError("the text form needs the timing row")
        summary = summary.withColumn("_one", F.lit(1)).join(timing.withColumn("_one", F.lit(1)), "_one")
        head = [F.lit(f"Validation Metrics for the checkpoint: {checkpoint}"),
                printed("Loss: %.3f, Accuracy: %.3f, Avg Batch Duration: %.3f seconds, Duration: %.3f seconds",
                        "loss", "accuracy", "avg_batch_duration", "duration")]
    else:
        raise ValueError(f"unknown form {form!r}")
    top = summary.select(F.posexplode(F.array(*head))).select(F.col("pos").cast("bigint").alias("line_no"), F.col("col").alias("value"))

    # blocks of lines follow each other at these offsets
    table_at, total_at, matrix_at, end_at = 10, 1 << 50, 1 << 51, 1 << 60
    table = (r.where("section = 'report'").groupBy("label", F.floor(F.col("position") / 4).alias("order"))
             .pivot("metric", ["precision", "recall", "f1_score", "support"]).agg(F.first("value")))
    # one row: the width of the label column
    width = table.agg(F.greatest(F.max(F.length("label")), F.lit(len("weighted avg"))).alias("w"))
    cell = lambda c: printed("%9.3f", c)
    support = F.format_string("%9d", F.col("support").cast("long"))
    name = F.lpad("label", F.col("w"), " ")
    text = F.when(F.col("precision").isNull(), F.concat(name, F.lit(" " * 21), F.lit(" "), cell("f1_score"), F.lit(" "), support)).otherwise(
        F.concat(name, F.lit("  "), cell("precision"), F.lit(" "), cell("recall"), F.lit(" "), cell("f1_score"), F.lit(" "), support))
    wide = table.withColumn("_one", F.lit(1)).join(width.withColumn("_one", F.lit(1)), "_one")
    body = wide.select(F.when(F.col("order") < (1 << 40), F.lit(table_at + 2) + F.col("order")).otherwise(
        F.lit(total_at + 1) + F.col("order") - F.lit(1 << 40)).cast("bigint").alias("line_no"), text.alias("value"))
    caption = F.concat(F.repeat(F.lit(" "), F.col("w")), F.format_string("  %9s %9s %9s %9s", *map(F.lit, ("precision", "recall", "f1-score", "support"))))
    captions = width.select(F.lit(table_at).cast("bigint").alias("line_no"), caption.alias("value"))
    # a matrix row is one line: as many numbers as there are labels
    matrix = r.where("section = 'matrix'").select(F.floor(F.col("position") / (1 << 31)).alias("t"), (F.col("position") % (1 << 31)).alias("p"),
                                                  F.col("value").cast("long").cast("string").alias("n"))
    digits = matrix.agg(F.max(F.length("n")).alias("d"), F.max("t").alias("last")).withColumn("_one", F.lit(1))
    rows = (matrix.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("p", "n"))).alias("c")).withColumn("_one", F.lit(1)).join(digits, "_one")
            .select((F.lit(matrix_at + 1) + F.col("t")).cast("bigint").alias("line_no"),
                    F.concat(F.when(F.col("t") == 0, "[[").otherwise(" ["),
                             F.array_join(F.transform("c", lambda x: F.lpad(x["n"], F.col("d"), " ")), " "),
                             F.when(F.col("t") == F.col("last"), "]]").otherwise("]")).alias("value")))
    fixed = [(table_at - 1, "Classification Report"), (table_at + 1, ""), (total_at, ""), (matrix_at - 1, ""),
             (matrix_at, "Confusion Matrix"), (end_at, "--------------------")]
    marks = spark.createDataFrame(fixed, "line_no bigint, value string")
    return top.unionByName(captions).unionByName(body).unionByName(rows).unionByName(marks)


def write_report(report: DataFrame, path: str, checkpoint: str, form: str = "image", timing: DataFrame | None = None) -> None:
    """``report.txt``-style text in line order."""
    write_lines(report_lines(report, checkpoint, form, timing), path)
