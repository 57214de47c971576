"""Registry: query key -> DuckDB SQL over the pre-registered table views.

Independent formulation of each query in :mod:`quarry.plans.queries` (windows,
unrolled CTEs), rounded the same way.
"""

from __future__ import annotations

from quarry.plans import oracle_fixtures as ofx

ORACLES: dict[str, str] = {}

D = "0.85::DOUBLE"
ONE_MINUS_D = "0.15::DOUBLE"


def _positive_zero(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB can round to -0.0
    where Spark's decimal rounding gives 0.0."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "(round(" + _positive_zero(sql[j + 6:k]) + ") + 0.0)")
        i = k + 1


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = _positive_zero(sql.strip())


def pagerank_sql(edges_sql: str, epochs: int = 10) -> str:
    """PageRank unrolled into ``epochs`` CTEs over an edge multiset."""
    ctes = [f"e AS ({edges_sql})",
            "deg AS (SELECT src, count(*) AS n FROM e GROUP BY src)",
            "r0 AS (SELECT src AS id, 1.0::DOUBLE AS rank FROM deg)"]
    for i in range(1, epochs + 1):
        ctes.append(
            f"r{i} AS (SELECT e.dst AS id, {ONE_MINUS_D} + {D} * sum(r.rank / deg.n) AS rank "
            f"FROM e JOIN deg ON e.src = deg.src JOIN r{i - 1} r ON r.id = e.src GROUP BY e.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT id, round(rank, 6) AS rank FROM r{epochs}"


# ----------------------------------------------------------------------- graph: steps

oracle("initial_ranks", f"SELECT DISTINCT src, 1.0::DOUBLE AS rank FROM ({ofx.G_CHAIN})")

oracle("edge_rank_join", f"SELECT src, dst, 1.0::DOUBLE AS rank FROM ({ofx.G_CHAIN})")

oracle("adjacency", f"""
SELECT src, dst, count(*) AS multiplicity, CAST(sum(count(*)) OVER (PARTITION BY src) AS BIGINT) AS out_degree
FROM ({ofx.G_CHAIN}) GROUP BY src, dst
""")

oracle("contributions", f"""
WITH e AS ({ofx.G_CHAIN}), deg AS (SELECT src, count(*) AS n FROM e GROUP BY src)
SELECT e.src, e.dst, round(1.0::DOUBLE / deg.n, 6) AS contribution FROM e JOIN deg ON e.src = deg.src
""")

oracle("damped_sum", pagerank_sql(ofx.G_CHAIN, epochs=1))

oracle("map_values", pagerank_sql(ofx.G_CHAIN, epochs=1))

oracle("char_contributions", f"""
SELECT unnest(string_split(dst, '')) AS ch, round(1.0::DOUBLE / length(dst), 6) AS contribution
FROM ({ofx.G_CHARS}) WHERE length(dst) > 0
""")

# ------------------------------------------------------------------------ graph: jobs

oracle("pagerank", pagerank_sql(ofx.G_CHAIN))
oracle("pagerank_ragged", pagerank_sql(ofx.G_RAGGED))
oracle("pagerank_partitioned", pagerank_sql(ofx.G_CHAIN))
oracle("pagerank_persisted", pagerank_sql(ofx.G_CHAIN))
oracle("tuple_text_sink", f"SELECT '(''' || id || ''', ' || CAST(rank + 0.0 AS VARCHAR) || ')' AS value FROM ({pagerank_sql(ofx.G_CHAIN)})")

_BUCKETED = f"""
SELECT src, dst, CASE WHEN p < 20 * s THEN p // s ELSE p - 20 * s END AS bucket FROM (
  SELECT src, dst, row_number() OVER (ORDER BY {ofx.hash_int(42, 'src', 'dst')}, src, dst) - 1 AS p,
         count(*) OVER () // 20 AS s
  FROM ({ofx.G_CHAIN}))
"""
oracle("pagerank_bucket_sample", pagerank_sql(f"SELECT src, dst FROM ({_BUCKETED}) WHERE bucket = 0"))

oracle("pagerank_as_written", f"""
SELECT ch AS id, round({ONE_MINUS_D} + {D} * sum(c), 6) AS rank FROM (
  SELECT unnest(string_split(dst, '')) AS ch, 1.0::DOUBLE / length(dst) AS c
  FROM ({ofx.G_CHARS}) WHERE length(dst) > 0) GROUP BY ch
""")

oracle("equal_random_buckets", f"""
SELECT event_id, CAST(CASE WHEN p < 20 * s THEN p // s ELSE p - 20 * s END AS INTEGER) AS bucket FROM (
  SELECT event_id, row_number() OVER (ORDER BY {ofx.hash_int(42, 'event_id')}, event_id) - 1 AS p,
         count(*) OVER () // 20 AS s
  FROM ({ofx.B_ROWS}))
""")


# ------------------------------------------------------------------ indexing / batches

oracle("dataset_split", f"SELECT event_id, {ofx.split_case('event_id', (80, 10, 10))} AS split FROM ({ofx.B_ROWS})")

oracle("assign_batches", f"""
SELECT event_id, 1 AS epoch, CAST(p % 4 AS INTEGER) AS rank, CAST((p // 4) // 64 AS INTEGER) AS step FROM (
  SELECT event_id, row_number() OVER (ORDER BY {ofx.hash_int(42, '1', 'event_id')}, event_id) - 1 AS p
  FROM ({ofx.B_ROWS}))
""")

# ----------------------------------------------------------------- sources and sorting

_SORTED = f"""
SELECT row_number() OVER (ORDER BY cca2 NULLS FIRST, "timestamp" NULLS FIRST, o_orderkey NULLS FIRST) - 1 AS pos, *
FROM ({ofx.T_SORT})
"""

oracle("sort_typed", f"""
SELECT row_number() OVER (ORDER BY CAST("timestamp" AS INTEGER), CAST(o_orderkey AS BIGINT)) - 1 AS pos, cca2,
       CAST("timestamp" AS INTEGER) AS "timestamp", CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus
FROM ({ofx.T_SORT})
""")
oracle("csv_scan", ofx.T_SORT)
oracle("sort_by_keys", _SORTED)
oracle("sort_single_partition", _SORTED)
oracle("csv_sink", _SORTED)
oracle("sort_csv_job", _SORTED)

oracle("text_edge_scan", ofx.G_TEXT)
oracle("comment_filter", f"SELECT value FROM ({ofx.G_TEXT}) WHERE NOT starts_with(value, '#')")
oracle("edge_parse", f"""
SELECT regexp_extract(value, '^(\\S*)\\s+(\\S*)', 1) AS src, regexp_extract(value, '^(\\S*)\\s+(\\S*)', 2) AS dst
FROM ({ofx.G_TEXT}) WHERE NOT starts_with(value, '#') AND regexp_matches(value, '\\s')
""")


# --------------------------------------------------------------- scoring / evaluation

def scored_sql(split: str | None = "validation") -> str:
    """Class-mean model (train split) scored on ``split``: one row per (vec_id, class)
    with logit and log-probability, plus the row's prediction, loss and batch. Without a
    split the whole table is scored."""
    chosen = f"WHERE split = '{split}'" if split else ""
    return f"""
WITH x AS ({ofx.X_VEC}),
cm AS (SELECT label AS c, i, avg(v) AS w FROM (
         SELECT label, unnest(features) AS v, generate_subscripts(features, 1) AS i FROM x WHERE split = 'train')
       GROUP BY label, i),
tgt AS (SELECT vec_id, label, features, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 16 AS INTEGER) AS batch
        FROM x {chosen}),
cells AS (SELECT vec_id, unnest(features) AS v, generate_subscripts(features, 1) AS i FROM tgt),
z AS (SELECT vec_id, c, sum(v * w) AS logit FROM cells JOIN cm USING (i) GROUP BY vec_id, c),
lp AS (SELECT vec_id, c, logit,
              logit - max(logit) OVER w - ln(sum(exp(logit - max(logit) OVER w2)) OVER w) AS log_prob
       FROM (SELECT *, 1 AS one FROM z) WINDOW w AS (PARTITION BY vec_id), w2 AS (PARTITION BY vec_id)),
pred AS (SELECT vec_id, c AS pred FROM (
           SELECT vec_id, c, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, c) AS k FROM z) WHERE k = 1),
rows AS (SELECT t.vec_id, t.label, t.batch, p.pred, -l.log_prob AS loss
         FROM tgt t JOIN pred p USING (vec_id) JOIN lp l ON l.vec_id = t.vec_id AND l.c = t.label)
"""


def _lp_sql(split: str | None = "validation") -> str:
    # log-softmax without nested window aggregates
    return scored_sql(split).replace(
        """lp AS (SELECT vec_id, c, logit,
              logit - max(logit) OVER w - ln(sum(exp(logit - max(logit) OVER w2)) OVER w) AS log_prob
       FROM (SELECT *, 1 AS one FROM z) WINDOW w AS (PARTITION BY vec_id), w2 AS (PARTITION BY vec_id)),""",
        """zm AS (SELECT vec_id, max(logit) AS m FROM z GROUP BY vec_id),
lse AS (SELECT z.vec_id, zm.m + ln(sum(exp(z.logit - zm.m))) AS s FROM z JOIN zm USING (vec_id) GROUP BY z.vec_id, zm.m),
lp AS (SELECT z.vec_id, z.c, z.logit, z.logit - lse.s AS log_prob FROM z JOIN lse USING (vec_id)),""")


SCORED = _lp_sql("validation")
SCORED_ALL = _lp_sql(None)

_MATRIX = """
labs AS (SELECT label AS l FROM rows UNION SELECT pred FROM rows),
cnt AS (SELECT label AS truth, pred, count(*) AS n FROM rows GROUP BY label, pred),
m AS (SELECT a.l AS truth, b.l AS pred, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
      FROM labs a CROSS JOIN labs b LEFT JOIN cnt ON cnt.truth = a.l AND cnt.pred = b.l),
per AS (SELECT truth AS label, CAST(sum(CASE WHEN truth = pred THEN n ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(n) AS BIGINT) AS support FROM m GROUP BY truth),
pr AS (SELECT pred AS label, CAST(sum(n) AS DOUBLE) AS predicted FROM m GROUP BY pred),
rep AS (SELECT label, tp, support,
               CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
               CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0.0 END AS f1_score
        FROM per JOIN pr USING (label)),
report AS (
  SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1_score, support FROM rep
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM rep
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM rep
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM rep)
"""

oracle("linear_logits", SCORED_ALL + "SELECT vec_id, CAST(c AS INTEGER) AS class, round(logit, 6) AS logit FROM lp")
oracle("log_softmax", SCORED_ALL + "SELECT vec_id, CAST(c AS INTEGER) AS class, round(log_prob, 6) AS log_prob FROM lp")
oracle("argmax_class", SCORED_ALL + "SELECT vec_id, label, CAST(pred AS INTEGER) AS pred FROM rows")
oracle("cross_entropy", SCORED_ALL + "SELECT vec_id, round(loss, 6) AS loss FROM rows")
oracle("score_join", SCORED_ALL.replace(
    "JOIN lp l ON l.vec_id = t.vec_id AND l.c = t.label", "JOIN lp l ON l.vec_id = t.vec_id AND l.c = 0")
    + "SELECT vec_id, CAST(pred AS INTEGER) AS pred FROM rows")
oracle("batch_score", SCORED + "SELECT vec_id, batch, label, CAST(pred AS INTEGER) AS pred, round(loss, 6) AS loss FROM rows")
oracle("accuracy", SCORED + "SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rows")
oracle("mean_of_batch_loss", SCORED + "SELECT round(avg(bl), 6) AS loss FROM (SELECT batch, avg(loss) AS bl FROM rows GROUP BY batch)")
oracle("confusion_matrix", SCORED + "," + _MATRIX + "SELECT CAST(truth AS INTEGER) AS truth, CAST(pred AS INTEGER) AS pred, n FROM m")
oracle("classification_report", SCORED + "," + _MATRIX + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support
FROM report""")
oracle("eval_report", SCORED + "," + _MATRIX + """
SELECT 'summary' AS section, '' AS label, 'loss' AS metric,
       round((SELECT avg(bl) FROM (SELECT batch, avg(loss) AS bl FROM rows GROUP BY batch)), 6) AS value
UNION ALL SELECT 'summary', '', 'accuracy', round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) FROM rows
UNION ALL SELECT 'report', label, 'precision', round(precision, 6) FROM report WHERE precision IS NOT NULL
UNION ALL SELECT 'report', label, 'recall', round(recall, 6) FROM report WHERE recall IS NOT NULL
UNION ALL SELECT 'report', label, 'f1_score', round(f1_score, 6) FROM report
UNION ALL SELECT 'report', label, 'support', CAST(support AS DOUBLE) FROM report
UNION ALL SELECT 'matrix', CAST(truth AS VARCHAR) || '|' || CAST(pred AS VARCHAR), 'n', CAST(n AS DOUBLE) FROM m
""")
oracle("parameter_count", f"""
SELECT CAST(count(DISTINCT label) * max(len(features)) + count(DISTINCT label) AS BIGINT) AS parameters
FROM ({ofx.X_VEC}) WHERE split = 'train'
""")


# ------------------------------------------------------------------------- telemetry

_TELE_COLS = "epoch, batch_idx, event_id, round(loss, 6) AS loss, round(accuracy, 6) AS accuracy, round(duration, 6) AS duration"


def _epochs_sql(skip_first: bool) -> str:
    dur = "CASE WHEN batch_idx > 0 THEN duration END" if skip_first else "duration"
    return f"""
SELECT epoch, avg(loss) AS train_loss, avg(accuracy) AS train_accuracy, avg({dur}) AS avg_batch_duration,
       sum(duration) AS epoch_duration, count(*) AS batches
FROM ({ofx.L_TELE}) GROUP BY epoch
"""


def _epochs_out(skip_first: bool) -> str:
    return f"""
SELECT epoch, round(train_loss, 6) AS train_loss, round(train_accuracy, 6) AS train_accuracy,
       round(avg_batch_duration, 6) AS avg_batch_duration, round(epoch_duration, 6) AS epoch_duration, batches
FROM ({_epochs_sql(skip_first)})
"""


oracle("telemetry_sample", f"SELECT {_TELE_COLS} FROM ({ofx.L_TELE}) WHERE batch_idx % 20 = 0")
oracle("telemetry_cap", f"SELECT {_TELE_COLS} FROM ({ofx.L_TELE}) WHERE batch_idx < 41")
oracle("epoch_summary_skip_first", _epochs_out(True))
oracle("epoch_summary_all", _epochs_out(False))
oracle("run_summary", f"""
SELECT round(avg(train_loss), 6) AS avg_train_loss, round(avg(train_accuracy), 6) AS avg_train_accuracy,
       round(avg(epoch_duration), 6) AS avg_epoch_duration, round(avg(avg_batch_duration), 6) AS avg_batch_duration,
       count(*) AS epochs
FROM ({_epochs_sql(False)})
""")
oracle("eval_timing", f"""
SELECT round(avg(duration), 6) AS avg_batch_duration, round(sum(duration), 6) AS duration, count(*) AS batches
FROM ({ofx.L_TELE})
""")
oracle("format_log_line", f"""
SELECT epoch, printf('Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, Avg Batch Duration: %.3f seconds, Epoch Duration: %.3f seconds',
                     epoch, train_loss, train_accuracy, avg_batch_duration,
                     epoch_duration) AS value
FROM ({_epochs_sql(True)})
""")

def _printed(columns: str, line: str, values: str, source: str) -> str:
    return f"SELECT {columns} printf('{line}', {values}) AS value FROM ({source})"


_BATCH_FORM = "Batch Idx: %d, Batch Loss: %.3f, Batch Accuracy: %.3f, Batch Duration: %.3f seconds"
_BATCH_VALUES = "batch_idx, loss, accuracy, duration"
oracle("format_batch_log", _printed("epoch, batch_idx,", _BATCH_FORM, _BATCH_VALUES, ofx.L_TELE))
oracle("format_text_batch_log", _printed(
    "epoch, batch_idx,", "Epoch: %d, Train Batch Idx: %d, Train Batch Loss: %.3f, Train Batch Accuracy: %.3f, Train Batch Duration: %.3f seconds",
    "epoch, " + _BATCH_VALUES, ofx.L_TELE))
oracle("format_text_epoch_log", _printed(
    "epoch,", "Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds",
    "epoch, train_loss, train_accuracy, epoch_duration, avg_batch_duration", _epochs_sql(False)))
oracle("format_text_run_log", _printed(
    "", "Avg Train Loss: %.3f, Avg Train Accuracy: %.3f, Avg Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds",
    "avg(train_loss), avg(train_accuracy), avg(epoch_duration), avg(avg_batch_duration)", _epochs_sql(False)))

oracle("train_log_sink", f"""
WITH t AS (SELECT *, CAST(event_id % 4 AS INTEGER) AS rank FROM ({ofx.L_TELE})),
lines AS (
  SELECT rank, 'Logs for the checkpoint stored at: /checkpoints/' || run || '/' AS value
  FROM (SELECT DISTINCT rank FROM t), (VALUES ('first'), ('second')) r(run)
  UNION ALL SELECT rank, value FROM (
    SELECT rank, printf('{_BATCH_FORM}', {_BATCH_VALUES}) AS value FROM t WHERE batch_idx % 20 = 0
    UNION ALL
    SELECT rank, 'Rank: ' || rank || ', ' || printf('Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, Avg Batch Duration: %.3f seconds, Epoch Duration: %.3f seconds',
      epoch, avg(loss), avg(accuracy), avg(CASE WHEN batch_idx > 0 THEN duration END), sum(duration))
    FROM t GROUP BY rank, epoch), (VALUES (1), (2)) twice(n))
SELECT rank, value, count(*) AS n FROM lines GROUP BY rank, value
""")
oracle("text_train_log_sink", f"""
WITH t AS ({ofx.L_TELE}), e AS ({_epochs_sql(False)}),
lines(o, k, value) AS (
  SELECT epoch, batch_idx, printf('Epoch: %d, Train Batch Idx: %d, Train Batch Loss: %.3f, Train Batch Accuracy: %.3f, Train Batch Duration: %.3f seconds',
    epoch, batch_idx, loss, accuracy, duration) FROM t WHERE batch_idx % 100 = 0
  UNION ALL SELECT epoch, 1000000000, printf('Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds',
    epoch, train_loss, train_accuracy, epoch_duration, avg_batch_duration) FROM e
  UNION ALL SELECT epoch, 1000000001, repeat('-', 46) FROM e
  UNION ALL SELECT 1000, 0, printf('Avg Train Loss: %.3f, Avg Train Accuracy: %.3f, Avg Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds',
    avg(train_loss), avg(train_accuracy), avg(epoch_duration), avg(avg_batch_duration)) FROM e
  UNION ALL SELECT 1000, 1, repeat('-', 46))
SELECT row_number() OVER (ORDER BY o, k) - 1 AS line_no, value FROM lines
""")
oracle("warmup_linear_lr", f"""
WITH t AS (SELECT CAST(3 * ceil(count(*) / 20.0) AS BIGINT) AS total FROM ({ofx.S_SENT}) WHERE split = 'train')
SELECT step, round(5e-5 * CASE WHEN step < 100 THEN step / 100.0
                         ELSE greatest(0.0, (total - step) / CAST(total - 100 AS DOUBLE)) END, 12) AS lr
FROM (SELECT unnest(range(total)) AS step, total FROM t)
""")


# -------------------------------------------------------------------------- features

oracle("scale_pixels", f"SELECT id, h, w, c, round(v / 255.0, 6) AS v FROM ({ofx.X_IMG_LONG})")
oracle("normalize_channels", f"""
SELECT id, h, w, c,
       round((v / 255.0 - [125.3 / 255.0, 123.0 / 255.0, 113.9 / 255.0][c + 1])
             / [63.0 / 255.0, 62.1 / 255.0, 66.7 / 255.0][c + 1], 6) AS v
FROM ({ofx.X_IMG_LONG})
""")
oracle("random_crop", f"""
WITH img AS ({ofx.X_IMG_LONG}),
off AS (SELECT DISTINCT id, {ofx.hash_mod(3, 42, '1', 'id', "'y'")} AS oy, {ofx.hash_mod(3, 42, '1', 'id', "'x'")} AS ox FROM img),
grid AS (SELECT off.id, g.h, g.w, g.c, off.oy, off.ox FROM off CROSS JOIN (SELECT DISTINCT h, w, c FROM img) g)
SELECT grid.id, CAST(grid.h AS INTEGER) AS h, CAST(grid.w AS INTEGER) AS w, CAST(grid.c AS INTEGER) AS c,
       coalesce(img.v, 0) AS v
FROM grid LEFT JOIN img ON img.id = grid.id AND img.h = grid.h + grid.oy - 1 AND img.w = grid.w + grid.ox - 1
                       AND img.c = grid.c
""")
oracle("random_flip", f"""
SELECT id, h, CASE WHEN {ofx.hash_mod(1000, 42, '1', 'id', "'flip'")} < 500 THEN 7 - w ELSE w END AS w, c, v
FROM ({ofx.X_IMG_LONG})
""")


# ------------------------------------------------------------------------------ text

_TEXT = f"""
WITH docs AS ({ofx.S_DOCS}),
sent AS ({ofx.S_SENT}),
w AS (SELECT idx, label, sentence, regexp_extract_all(lower(coalesce(sentence, '')), '\\p{{L}}+') AS ws FROM docs),
vc AS (SELECT word, count(*) AS cnt FROM (SELECT unnest(ws) AS word FROM w) GROUP BY word),
vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY cnt DESC, word) + 3 AS INTEGER) AS id, cnt AS count FROM vc),
tok AS (SELECT t.idx, t.pos, v.id FROM (
          SELECT idx, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w) t JOIN vocab v ON v.word = t.word),
win AS (SELECT idx, label, unnest(range(greatest(1, CAST(ceil(len(ws) / 510.0) AS BIGINT)))) AS wno FROM w),
enc AS (SELECT n.idx, n.label, CAST(n.wno AS INTEGER) AS wno,
               coalesce(list(tok.id ORDER BY tok.pos) FILTER (WHERE tok.id IS NOT NULL), []) AS ids
        FROM win n LEFT JOIN tok ON tok.idx = n.idx AND tok.pos // 510 = n.wno GROUP BY n.idx, n.label, n.wno)
"""

_PADDED = """array_to_string(list_concat([2], ids, [3], list_transform(range(510 - len(ids)), lambda q: 0)), ' ') AS input_ids,
       CAST(len(ids) + 2 AS INTEGER) AS mask_len, 0 AS type_sum, 512 AS length"""

oracle("build_vocab", _TEXT + "SELECT word, id, count FROM vocab")
oracle("encode_text", _TEXT + f'SELECT idx, wno AS "window", {_PADDED} FROM enc')
oracle("drop_columns", _TEXT + f'SELECT CAST(label AS VARCHAR) AS label, wno AS "window", {_PADDED} FROM enc')

_NB = _TEXT.rstrip() + """,
train AS (SELECT idx, label FROM sent WHERE split = 'train'),
tr AS (SELECT train.label, tok.id FROM train JOIN tok USING (idx)),
wcnt AS (SELECT label AS c, id, count(*) AS n FROM tr GROUP BY label, id),
ctok AS (SELECT label AS c, count(*) AS n FROM tr GROUP BY label),
cdoc AS (SELECT label AS c, count(*) AS n FROM train GROUP BY label),
nv AS (SELECT count(*) + 4 AS v FROM vocab),
classes AS (SELECT c FROM cdoc),
sc AS (SELECT t.idx, k.c,
              ln(cdoc.n / (SELECT sum(n) FROM cdoc)) - count(tt.id) * ln(ctok.n + (SELECT v FROM nv))
              + coalesce(sum(ln(coalesce(wcnt.n, 0) + 1.0)), 0.0) AS score
       FROM docs t CROSS JOIN classes k JOIN cdoc ON cdoc.c = k.c JOIN ctok ON ctok.c = k.c
       LEFT JOIN tok tt ON tt.idx = t.idx
       LEFT JOIN wcnt ON wcnt.id = tt.id AND wcnt.c = k.c
       GROUP BY t.idx, k.c, cdoc.n, ctok.n),
best AS (SELECT idx, c AS pred FROM (SELECT idx, c, row_number() OVER (PARTITION BY idx ORDER BY score DESC, c) AS r FROM sc) WHERE r = 1)
"""

oracle("project_predictions", _NB + """
SELECT t.idx, t.sentence AS Sentence, CAST(t.label AS VARCHAR) AS GroundTruth, CAST(best.pred AS INTEGER) AS Prediction
FROM docs t JOIN best USING (idx)
""")
oracle("predictions_sink", _NB + """
SELECT row_number() OVER (ORDER BY t.idx) - 1 AS pos, t.sentence AS Sentence, CAST(best.pred AS VARCHAR) AS Prediction
FROM docs t JOIN best USING (idx)
""")


# -------------------------------------------------------------------------- training

def _batched(where: str) -> str:
    return f"""
WITH x AS ({ofx.X_VEC}),
t AS (SELECT vec_id, label, features,
             row_number() OVER (ORDER BY {ofx.hash_int(42, '1', 'vec_id')}, vec_id) - 1 AS p
      FROM x {where}),
b AS (SELECT vec_id, label, features, CAST(p % 4 AS INTEGER) AS rank, CAST((p // 4) // 64 AS INTEGER) AS step FROM t),
"""


_BATCHED = _batched("")

oracle("collate_batches", _BATCHED + """
z AS (SELECT 1)
SELECT 1 AS epoch, rank, step, CAST(count(*) AS INTEGER) AS size, min(vec_id) AS first_id, max(vec_id) AS last_id,
       CAST(sum(label) AS BIGINT) AS label_sum
FROM b GROUP BY rank, step
""")

oracle("uncollate_batches", _BATCHED + """
z AS (SELECT 1)
SELECT 1 AS epoch, rank, step, vec_id, label, CAST(len(features) AS INTEGER) AS n_features,
       round(features[1], 6) AS first_feature FROM b
""")

# gradient of the mean cross-entropy at zero weights: softmax is 1/C for every class
_ZERO_GRAD_BODY = """
k AS (SELECT max(label) + 1 AS nc, max(len(features)) AS nd FROM b),
cls AS (SELECT unnest(range(nc)) AS c FROM k),
cells AS (SELECT step, rank, label, unnest(features) AS v, generate_subscripts(features, 1) - 1 AS d FROM b),
rg AS (SELECT step, rank, c, d, avg((1.0 / (SELECT nc FROM k) - CASE WHEN label = c THEN 1.0 ELSE 0.0 END) * v) AS g
       FROM cells CROSS JOIN cls GROUP BY step, rank, c, d),
rb AS (SELECT step, rank, c, avg(1.0 / (SELECT nc FROM k) - CASE WHEN label = c THEN 1.0 ELSE 0.0 END) AS g
       FROM b CROSS JOIN cls GROUP BY step, rank, c),
parts AS (SELECT step, rank, CAST(c * (SELECT nd FROM k) + d AS INTEGER) AS j, g FROM rg
          UNION ALL SELECT step, rank, CAST((SELECT nc * nd FROM k) + c AS INTEGER), g FROM rb)
"""
_ZERO_GRAD = _BATCHED + _ZERO_GRAD_BODY

oracle("combine_gather_mean", _ZERO_GRAD + "SELECT step, j, round(avg(g), 9) AS grad FROM parts GROUP BY step, j")
oracle("combine_allreduce", _ZERO_GRAD + "SELECT step, j, round(sum(g / 4.0), 9) AS grad FROM parts GROUP BY step, j")
oracle("combine_equivalence", _ZERO_GRAD + """
SELECT round(max(abs(a - s)), 9) AS max_abs_diff FROM (SELECT step, j, avg(g) AS a, sum(g / 4.0) AS s FROM parts GROUP BY step, j)
""")
oracle("softmax_gradient_step", _batched("WHERE split = 'train'") + _ZERO_GRAD_BODY + """
SELECT j, round(avg(g), 9) AS grad, round(-0.1 * avg(g), 9) AS weight FROM parts WHERE step = 0 GROUP BY j
""")


def _sgd_full_batch_sql(steps: int = 3, lr: float = 0.1, momentum: float = 0.9, wd: float = 1e-4) -> str:
    """Full-batch SGD from zero weights, unrolled: g = mean grad + wd * w; v = m * v + g
    (v = g on the first step); w = w - lr * v. Parameters are ``(j, w)`` with
    ``j = c * D + d`` for weights and ``C * D + c`` for biases."""
    ctes = [f"x AS ({ofx.X_VEC})",
            "t AS (SELECT vec_id AS i, label, features FROM x WHERE split = 'train')",
            "k AS (SELECT max(label) + 1 AS nc, max(len(features)) AS nd, count(*) AS nrows FROM t)",
            "cls AS (SELECT unnest(range(nc)) AS c FROM k)",
            "cells AS (SELECT i, unnest(features) AS v, generate_subscripts(features, 1) - 1 AS d FROM t)",
            "p0 AS (SELECT unnest(range(nc * nd + nc)) AS j, 0.0::DOUBLE AS w, 0.0::DOUBLE AS mom FROM k)"]
    for s in range(steps):
        cur, nxt = f"p{s}", f"p{s + 1}"
        mom = "" if s == 0 else f"{momentum} * p.mom + "
        ctes += [
            f"zw{s} AS (SELECT cells.i, cls.c, sum(cells.v * wt.w) AS zw FROM cells CROSS JOIN cls CROSS JOIN k "
            f"JOIN {cur} wt ON wt.j = cls.c * k.nd + cells.d GROUP BY cells.i, cls.c)",
            f"z{s} AS (SELECT zw.i, zw.c, zw.zw + bb.w AS z FROM zw{s} zw CROSS JOIN k "
            f"JOIN {cur} bb ON bb.j = k.nc * k.nd + zw.c)",
            f"zm{s} AS (SELECT i, max(z) AS m FROM z{s} GROUP BY i)",
            f"lse{s} AS (SELECT z.i, zm.m + ln(sum(exp(z.z - zm.m))) AS s FROM z{s} z JOIN zm{s} zm ON zm.i = z.i "
            f"GROUP BY z.i, zm.m)",
            f"r{s} AS (SELECT z.i, z.c, exp(z.z - l.s) - CASE WHEN t.label = z.c THEN 1.0 ELSE 0.0 END AS e "
            f"FROM z{s} z JOIN lse{s} l ON l.i = z.i JOIN t ON t.i = z.i)",
            f"g{s} AS (SELECT CAST(r.c * k.nd + cells.d AS BIGINT) AS j, sum(r.e * cells.v) / any_value(k.nrows) AS g "
            f"FROM r{s} r JOIN cells ON cells.i = r.i CROSS JOIN k GROUP BY r.c, cells.d, k.nd "
            f"UNION ALL SELECT CAST(k.nc * k.nd + r.c AS BIGINT), sum(r.e) / any_value(k.nrows) "
            f"FROM r{s} r CROSS JOIN k GROUP BY r.c, k.nc, k.nd)",
            f"{nxt} AS (SELECT j, w - {lr} * v AS w, v AS mom FROM (SELECT p.j, p.w, "
            f"{mom}(g.g + {wd} * p.w) AS v FROM {cur} p JOIN g{s} g ON g.j = p.j))",
        ]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT CAST(j AS INTEGER) AS j, round(w, 6) AS value FROM p{steps}"


oracle("train_sgd_full_batch", _sgd_full_batch_sql())


def _train_sql(epochs: int, steps: int = 2, adamw: bool = False) -> str:
    """``epochs`` x ``steps`` mini-batch steps of 4 ranks x 64 rows from zero weights, unrolled
    (the vector table of sf0.01 and below has two steps an epoch). ``p<i>`` are the
    parameters ``(j, w, a, b)`` after i steps, ``loss<i>`` the step's mean rank loss.

    SGD: v = g + 1e-4 w, plus 0.9 times the last v; w -= 0.1 v. AdamW: g clipped to norm 1,
    then decoupled decay 0.01, moments 0.9 and 0.999 with bias correction, rate 5e-3 with 2
    warm-up steps and linear decay to 0.
    """
    total = epochs * steps
    ctes = [f"x AS ({ofx.X_VEC})", "t AS (SELECT vec_id AS i, label, features FROM x WHERE split = 'train')",
            "k AS (SELECT max(label) + 1 AS nc, max(len(features)) AS nd FROM t)", "cls AS (SELECT unnest(range(nc)) AS c FROM k)",
            "cells AS (SELECT i, unnest(features) AS v, generate_subscripts(features, 1) - 1 AS d FROM t)",
            "p0 AS (SELECT unnest(range(nc * nd + nc)) AS j, 0.0::DOUBLE AS w, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM k)"]
    for e in range(1, epochs + 1):
        # a row's weight in its step: the mean over its rank's rows, then over the ranks present
        ctes += [f"o{e} AS (SELECT i, p % 4 AS rank, (p // 4) // 64 AS step FROM "
                 f"(SELECT i, row_number() OVER (ORDER BY {ofx.hash_int(42, f"'{e}'", 'i')}, i) - 1 AS p FROM t))",
                 f"n{e} AS (SELECT step, rank, count(*) AS n FROM o{e} GROUP BY step, rank)",
                 f"q{e} AS (SELECT step, count(*) AS ranks FROM n{e} GROUP BY step)"]
    for n in range(total):
        e, s = n // steps + 1, n % steps
        if adamw:
            lr = 5e-3 * (n / 2 if n < 2 else max(0.0, (total - n) / max(1, total - 2)))
            update = (f"SELECT j, w * (1 - {lr!r} * 0.01) - {lr!r} * (a / (1 - pow(0.9, {n + 1}))) / (sqrt(b / (1 - pow(0.999, {n + 1}))) + 1e-8) AS w, a, b "
                      f"FROM (SELECT p.j, p.w, 0.9 * p.a + 0.1 * h.g AS a, 0.999 * p.b + 0.001 * h.g * h.g AS b FROM p{n} p JOIN h{n} h ON h.j = p.j)")
            clip = f"SELECT j, g * least(1.0, 1.0 / ((SELECT sqrt(sum(g * g)) FROM g{n}) + 1e-6)) AS g FROM g{n}"
        else:
            update = (f"SELECT j, w - 0.1 * a AS w, a, b FROM (SELECT p.j, p.w, p.b, {'0.9 * p.a + ' if n else ''}(h.g + 1e-4 * p.w) AS a "
                      f"FROM p{n} p JOIN h{n} h ON h.j = p.j)")
            clip = f"SELECT j, g FROM g{n}"
        ctes += [
            f"m{n} AS (SELECT o.i, 1.0::DOUBLE / nn.n / qq.ranks AS share FROM o{e} o JOIN n{e} nn ON nn.step = o.step AND nn.rank = o.rank "
            f"JOIN q{e} qq ON qq.step = o.step WHERE o.step = {s})",
            f"c{n} AS (SELECT cells.i, cells.d, cells.v FROM cells WHERE cells.i IN (SELECT i FROM m{n}))",
            f"zw{n} AS (SELECT x.i, cls.c, sum(x.v * wt.w) AS zw FROM c{n} x CROSS JOIN cls CROSS JOIN k "
            f"JOIN p{n} wt ON wt.j = cls.c * k.nd + x.d GROUP BY x.i, cls.c)",
            f"z{n} AS (SELECT zw.i, zw.c, zw.zw + bb.w AS z FROM zw{n} zw CROSS JOIN k JOIN p{n} bb ON bb.j = k.nc * k.nd + zw.c)",
            f"zm{n} AS (SELECT i, max(z) AS m FROM z{n} GROUP BY i)",
            f"s{n} AS (SELECT z.i, zm.m + ln(sum(exp(z.z - zm.m))) AS s FROM z{n} z JOIN zm{n} zm ON zm.i = z.i GROUP BY z.i, zm.m)",
            f"r{n} AS (SELECT z.i, z.c, m.share * (exp(z.z - s.s) - CASE WHEN t.label = z.c THEN 1.0 ELSE 0.0 END) AS e, "
            f"CASE WHEN t.label = z.c THEN m.share * (s.s - z.z) ELSE 0.0 END AS l FROM z{n} z JOIN s{n} s ON s.i = z.i JOIN t ON t.i = z.i JOIN m{n} m ON m.i = z.i)",
            f"loss{n} AS (SELECT sum(l) AS l FROM r{n})",
            f"g{n} AS (SELECT CAST(r.c * k.nd + x.d AS BIGINT) AS j, sum(r.e * x.v) AS g FROM r{n} r JOIN c{n} x ON x.i = r.i CROSS JOIN k "
            f"GROUP BY r.c, x.d, k.nd UNION ALL SELECT CAST(k.nc * k.nd + r.c AS BIGINT), sum(r.e) FROM r{n} r CROSS JOIN k GROUP BY r.c, k.nc, k.nd)",
            f"h{n} AS ({clip})", f"p{n + 1} AS ({update})"]
    return "WITH " + ",\n".join(ctes) + "\n"


oracle("train_sgd", _train_sql(1) + "SELECT CAST(j AS INTEGER) AS j, round(w, 6) AS value FROM p2")


def _fit_sql(epochs: int, adamw: bool = False) -> str:
    """As :func:`_train_sql`, over every step of an epoch, however many the table has: ``p`` has
    the parameters ``(n, j, w, a, b)`` after n steps, and ``l``, the mean rank loss of the
    last of them; ``size`` the steps of an epoch and of the run."""
    if adamw:
        clip = "SELECT j, g * least(1.0, 1.0 / ((SELECT sqrt(sum(g * g)) FROM g) + 1e-6)) AS g FROM g"
        update = f"""SELECT q.n + 1, q.j, q.w * (1 - q.lr * 0.01) - q.lr * (q.a / (1 - pow(0.9, q.n + 1))) / (sqrt(q.b / (1 - pow(0.999, q.n + 1))) + 1e-8), q.a, q.b, q.l
    FROM (SELECT p.n, p.j, p.w, 0.9 * p.a + 0.1 * h.g AS a, 0.999 * p.b + 0.001 * h.g * h.g AS b, loss.l,
                 5e-3 * CASE WHEN p.n < 2 THEN p.n / 2.0::DOUBLE ELSE greatest(0.0, (total - p.n)::DOUBLE / greatest(1, total - 2)) END AS lr
          FROM p JOIN h ON h.j = p.j CROSS JOIN loss CROSS JOIN size WHERE p.n < total) q"""
    else:
        clip = "SELECT j, g FROM g"
        update = """SELECT q.n + 1, q.j, q.w - 0.1 * q.a, q.a, q.b, q.l
    FROM (SELECT p.n, p.j, p.w, 0.9 * p.a + (h.g + 1e-4 * p.w) AS a, p.b, loss.l
          FROM p JOIN h ON h.j = p.j CROSS JOIN loss CROSS JOIN size WHERE p.n < total) q"""
    return f"""WITH RECURSIVE x AS ({ofx.X_VEC}),
t AS MATERIALIZED (SELECT vec_id AS i, label, features FROM x WHERE split = 'train'),
k AS MATERIALIZED (SELECT max(label) + 1 AS nc, max(len(features)) AS nd FROM t),
cls AS MATERIALIZED (SELECT unnest(range(nc)) AS c FROM k),
o AS MATERIALIZED (SELECT e, i, p % 4 AS rank, (p // 4) // 64 AS step FROM
  (SELECT e, i, row_number() OVER (PARTITION BY e ORDER BY {ofx.hash_int(42, 'e', 'i')}, i) - 1 AS p
   FROM t CROSS JOIN (SELECT unnest(range(1, {epochs + 1})) AS e))),
size AS MATERIALIZED (SELECT max(step) + 1 AS steps, {epochs} * (max(step) + 1) AS total FROM o),
per_rank AS (SELECT e, step, rank, count(*) AS n FROM o GROUP BY e, step, rank),
per_step AS (SELECT e, step, count(*) AS ranks FROM per_rank GROUP BY e, step),
m AS MATERIALIZED (SELECT (o.e - 1) * size.steps + o.step AS n, o.i, 1.0::DOUBLE / r.n / s.ranks AS share FROM o
  JOIN per_rank r ON r.e = o.e AND r.step = o.step AND r.rank = o.rank JOIN per_step s ON s.e = o.e AND s.step = o.step CROSS JOIN size),
p(n, j, w, a, b, l) AS (
  SELECT 0::BIGINT, unnest(range(nc * nd + nc))::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE FROM k
  UNION ALL
  (WITH now AS MATERIALIZED (SELECT t.i, t.label, t.features, m.share FROM m JOIN t ON t.i = m.i WHERE m.n = (SELECT max(n) FROM p)),
  c AS MATERIALIZED (SELECT i, unnest(features) AS v, generate_subscripts(features, 1) - 1 AS d FROM now),
  zw AS (SELECT c.i, cls.c, sum(c.v * p.w) AS zw FROM c CROSS JOIN cls CROSS JOIN k JOIN p ON p.j = cls.c * k.nd + c.d GROUP BY c.i, cls.c),
  z AS MATERIALIZED (SELECT zw.i, zw.c, zw.zw + p.w AS z FROM zw CROSS JOIN k JOIN p ON p.j = k.nc * k.nd + zw.c),
  zm AS (SELECT i, max(z) AS top FROM z GROUP BY i),
  s AS (SELECT z.i, zm.top + ln(sum(exp(z.z - zm.top))) AS s FROM z JOIN zm ON zm.i = z.i GROUP BY z.i, zm.top),
  r AS MATERIALIZED (SELECT z.i, z.c, now.share * (exp(z.z - s.s) - CASE WHEN now.label = z.c THEN 1.0 ELSE 0.0 END) AS e,
    CASE WHEN now.label = z.c THEN now.share * (s.s - z.z) ELSE 0.0 END AS l FROM z JOIN s ON s.i = z.i JOIN now ON now.i = z.i),
  loss AS (SELECT sum(l) AS l FROM r),
  g AS MATERIALIZED (SELECT CAST(r.c * k.nd + c.d AS BIGINT) AS j, sum(r.e * c.v) AS g FROM r JOIN c ON c.i = r.i CROSS JOIN k GROUP BY r.c, c.d, k.nd
    UNION ALL SELECT CAST(k.nc * k.nd + r.c AS BIGINT), sum(r.e) FROM r CROSS JOIN k GROUP BY r.c, k.nc, k.nd),
  h AS ({clip})
  {update}))
"""


oracle("train_adamw", _fit_sql(3, adamw=True) + "SELECT CAST(j AS INTEGER) AS j, round(w, 6) AS value FROM p JOIN size ON n = total")
oracle("train_resume", _fit_sql(2) + "SELECT CAST(j AS INTEGER) AS j, round(w, 6) AS resumed, 0.0::DOUBLE AS max_abs_diff_to_straight FROM p JOIN size ON n = total")
oracle("checkpoint_sink", _fit_sql(2) + """,
losses AS (SELECT (n - 1) // steps + 1 AS version, avg(l) AS loss FROM (SELECT DISTINCT n, l FROM p WHERE n > 0) CROSS JOIN size GROUP BY 1)
SELECT v.version, n.name, sl.slot, CASE WHEN n.name = 'weight' THEN k.nc || 'x' || k.nd ELSE CAST(k.nc AS VARCHAR) END AS shape,
       CAST(CASE WHEN n.name = 'weight' THEN k.nc * k.nd ELSE k.nc END AS INTEGER) AS n_values, CAST(size.steps * v.version AS BIGINT) AS step, v.version AS epoch,
       round(losses.loss, 6) AS loss
FROM (VALUES (1), (2)) v(version) JOIN losses ON losses.version = v.version,
     (VALUES ('weight'), ('bias')) n(name), (VALUES ('value'), ('momentum')) sl(slot), k, size
""".lstrip("\n"))
oracle("checkpoint_load", _train_sql(1) + """,
y AS (SELECT vec_id AS i, label, features FROM x WHERE split = 'validation'),
yc AS (SELECT i, unnest(features) AS v, generate_subscripts(features, 1) - 1 AS d FROM y),
q AS (SELECT yc.i, cls.c, sum(yc.v * wt.w) + any_value(bb.w) AS z FROM yc CROSS JOIN cls CROSS JOIN k JOIN p2 wt ON wt.j = cls.c * k.nd + yc.d
      JOIN p2 bb ON bb.j = k.nc * k.nd + cls.c GROUP BY yc.i, cls.c),
qs AS (SELECT i, top + ln(sum(exp(z - top))) AS s FROM q JOIN (SELECT i, max(z) AS top FROM q GROUP BY i) USING (i) GROUP BY i, top),
best AS (SELECT i, c FROM (SELECT i, c, row_number() OVER (PARTITION BY i ORDER BY z DESC, c) AS o FROM q) WHERE o = 1)
SELECT y.i AS vec_id, y.label, CAST(best.c AS INTEGER) AS pred, round(qs.s - q.z, 6) AS loss
FROM y JOIN best USING (i) JOIN qs USING (i) JOIN q ON q.i = y.i AND q.c = y.label
""".lstrip("\n"))


def _report_sql(scored: str, head: str, names: str) -> str:
    """The report text as (line_no, value): head lines, table, matrix, separator; ``rows`` of
    ``scored`` has label, pred, loss, batch."""
    cell = lambda c: f"lpad(printf('%.3f', {c}), 9, ' ')"
    return scored + "," + _MATRIX + f""",
lab AS (SELECT l, row_number() OVER (ORDER BY l) - 1 AS o, {names} AS name FROM labs),
per_line AS (SELECT lab.o, lab.name AS label, r.precision, r.recall, r.f1_score, r.support FROM rep r JOIN lab ON lab.l = r.label
  UNION ALL SELECT CASE label WHEN 'accuracy' THEN 100001 WHEN 'macro avg' THEN 100002 ELSE 100003 END, label, precision, recall, f1_score, support
  FROM report WHERE label IN ('accuracy', 'macro avg', 'weighted avg')),
width AS (SELECT max(greatest(length(label), 12)) AS w FROM per_line),
digits AS (SELECT max(length(CAST(n AS VARCHAR))) AS d FROM m),
lines AS (
  {head}
  UNION ALL SELECT 2, 'Classification Report'
  UNION ALL SELECT 3, repeat(' ', w) || '  precision    recall  f1-score   support' FROM width
  UNION ALL SELECT 4, '' UNION ALL SELECT 100000, '' UNION ALL SELECT 100009, '' UNION ALL SELECT 100010, 'Confusion Matrix'
  UNION ALL SELECT 10 + o + CASE WHEN o > 100000 THEN -10 ELSE 0 END, lpad(label, CAST(w AS INTEGER), ' ')
    || CASE WHEN precision IS NULL THEN repeat(' ', 22) ELSE '  ' || {cell('precision')} || ' ' || {cell('recall')} || ' ' END
    || {cell('f1_score')} || ' ' || lpad(CAST(support AS VARCHAR), 9, ' ') FROM per_line CROSS JOIN width
  UNION ALL SELECT 200000 + o, CASE WHEN o = 0 THEN '[[' ELSE ' [' END || text || CASE WHEN o = (SELECT max(o) FROM lab) THEN ']]' ELSE ']' END
    FROM (SELECT a.o, string_agg(lpad(CAST(m.n AS VARCHAR), CAST(d AS INTEGER), ' '), ' ' ORDER BY b.o) AS text
          FROM m JOIN lab a ON a.l = m.truth JOIN lab b ON b.l = m.pred CROSS JOIN digits GROUP BY a.o)
  UNION ALL SELECT 900000, '--------------------')
SELECT row_number() OVER (ORDER BY n) - 1 AS line_no, value FROM lines l(n, value)
"""


_LOSS = "(SELECT avg(bl) FROM (SELECT batch, avg(loss) AS bl FROM rows GROUP BY batch))"
_RIGHT = "(SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) FROM rows)"
ORACLES["report_sink"] = _report_sql(SCORED, f"""SELECT 0 AS n, 'Metrics for the checkpoint: class-mean' AS value
  UNION ALL SELECT 1, printf('Test Loss: %.3f, Test Accuracy: %.3f', {_LOSS}, {_RIGHT})""", "CAST(l AS VARCHAR)").strip()
ORACLES["text_report_sink"] = _report_sql(
    _NB.rstrip() + """,
held AS (SELECT idx, label, (row_number() OVER (ORDER BY idx) - 1) // 20 AS batch FROM sent WHERE split = 'validation'),
total AS (SELECT idx, top + ln(sum(exp(score - top))) AS s FROM sc JOIN (SELECT idx, max(score) AS top FROM sc GROUP BY idx) USING (idx) GROUP BY idx, top),
rows AS (SELECT h.idx, h.label, best.pred, h.batch, total.s - sc.score AS loss
         FROM held h JOIN best USING (idx) JOIN total USING (idx) LEFT JOIN sc ON sc.idx = h.idx AND sc.c = h.label)""",
    f"""SELECT 0 AS n, 'Validation Metrics for the checkpoint: bag-of-ids' AS value
  UNION ALL SELECT 1, printf('Loss: %.3f, Accuracy: %.3f, Avg Batch Duration: %.3f seconds, Duration: %.3f seconds', {_LOSS}, {_RIGHT},
      (SELECT avg(duration) FROM ({ofx.L_TELE})), (SELECT sum(duration) FROM ({ofx.L_TELE})))""",
    "CASE l WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE CAST(l AS VARCHAR) END").strip()
ORACLES["score_class_rows"] = ORACLES["batch_score"]
ORACLES["encode_subwords"] = f"SELECT idx, regexp_replace(lower(coalesce(sentence, '')), '\\s+', '', 'g') AS spelled FROM ({ofx.S_DOCS})"
