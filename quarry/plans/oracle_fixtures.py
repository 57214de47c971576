"""SQL (DuckDB dialect) twins of :mod:`quarry.plans.fixtures`.

Each constant is the body of a CTE over the pre-registered table views.
"""

from __future__ import annotations


def hash_int(seed, *parts: str) -> str:
    """SQL for ``hash_int``: first 8 hex digits of md5(concat_ws('|', ...))."""
    args = ", ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {args})), 1, 8)) AS BIGINT)"


def hash_mod(modulus: int, seed, *parts: str) -> str:
    return f"({hash_int(seed, *parts)} % {modulus})"


G_CHAIN = """
  SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(dst0 AS VARCHAR) AS dst FROM (
    SELECT l_partkey, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst0
    FROM lineitem) WHERE dst0 IS NOT NULL
"""

G_RAGGED = f"""
  SELECT 'P' || src AS src, 'P' || dst AS dst FROM ({G_CHAIN})
  UNION ALL
  SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'P' || CAST(l_partkey AS VARCHAR) FROM lineitem
  UNION ALL
  SELECT 'P' || CAST(l_partkey AS VARCHAR), 'C' || CAST(o_custkey AS VARCHAR)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1
"""

G_CHARS = """
  SELECT DISTINCT c_name AS src, n_name AS dst FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

_STYLE = hash_mod(10, 7, "src", "dst")

G_TEXT = f"""
  SELECT CASE {_STYLE}
    WHEN 0 THEN 'P' || src || chr(9) || 'P' || dst
    WHEN 1 THEN 'P' || src || '   ' || 'P' || dst
    WHEN 2 THEN 'P' || src || ' ' || 'P' || dst || ' w=' || src
    WHEN 3 THEN 'P' || src || chr(9) || ' ' || chr(9) || 'P' || dst || chr(9)
    WHEN 4 THEN ' ' || 'P' || src || ' ' || 'P' || dst
    WHEN 5 THEN 'P' || src
    WHEN 6 THEN '# ' || 'P' || src || ' ' || 'P' || dst
    WHEN 7 THEN 'P' || src || ' '
    ELSE 'P' || src || ' ' || 'P' || dst END AS value
  FROM ({G_CHAIN})
"""

T_SORT = """
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS cca2,
         CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS VARCHAR) AS "timestamp",
         CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus
  FROM orders
"""

B_ROWS = "SELECT event_id, user_id, event_type, value FROM events"


def split_case(key: str, fractions, seed: int = 42,
               names=("train", "validation", "test")) -> str:
    h = hash_mod(100, seed, key)
    parts, upper = [], 0
    for frac, name in zip(fractions, names):
        upper += frac
        parts.append(f"WHEN {h} < {upper} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


X_VEC = f"""
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS features, label,
         {split_case('vec_id', (60, 20, 20))} AS split
  FROM embeddings
"""

S_SENT = f"""
  SELECT d.doc_id AS idx, d.text AS sentence, l.quality AS label,
         {split_case('d.doc_id', (80, 10, 10))} AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

L_TELE = """
  SELECT epoch, CAST(row_number() OVER (PARTITION BY epoch ORDER BY ts, event_id) - 1 AS INTEGER) AS batch_idx,
         event_id, loss, accuracy, duration
  FROM (SELECT CAST(user_id % 3 + 1 AS INTEGER) AS epoch, ts, event_id, value AS loss,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS accuracy,
               value / 10.0 AS duration
        FROM events)
"""

# all documents, labelled or not
S_DOCS = """
  SELECT d.doc_id AS idx, d.text AS sentence, l.quality AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# raw 8x8x3 image: value i = h*8 + w (0-based) of the embedding, channels x, -x and x/2
X_IMG_LONG = """
  SELECT vec_id AS id, label, CAST(i // 8 AS INTEGER) AS h, CAST(i % 8 AS INTEGER) AS w, c,
         CAST(least(greatest(floor((CAST(x AS DOUBLE) * f + 1.0) * 127.5), 0), 255) AS INTEGER) AS v
  FROM (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(64)) AS i FROM embeddings),
       (VALUES (0, 1.0::DOUBLE), (1, -1.0::DOUBLE), (2, 0.5::DOUBLE)) k(c, f)
"""
