"""The BFR rounds as one SQL statement over the embeddings, for comparison only.

Each step is a materialised common table. Cluster keys only have to keep the order in which
clusters arise: discard clusters count from 0, later ones from a base per round.
"""

from __future__ import annotations

# Written out here, so that the SQL doesn't follow the package.
SAMPLE_POINTS, SAMPLE_SHARE = 10_000, 0.1
DISCARD_ROUNDS, FIRST_REST_ROUNDS, RETAINED_ROUNDS, CLUSTER_FACTOR = 5, 3, 5, 3

ROUND_BASE = 1_000_000
MERGED_BASE = 500_000


def _distance(point: str, mean: str, mean_square: str) -> str:
    variance = f"greatest({mean_square}[i] - {mean}[i] * {mean}[i], 0)"
    gap = f"({point}[i] - {mean}[i])"
    return f"""sqrt(list_sum(list_transform(range(1, len({mean}) + 1), lambda i:
      CASE WHEN {variance} = 0 THEN CASE WHEN {gap} = 0 THEN 0 ELSE 'Infinity'::DOUBLE END
           ELSE {gap} * {gap} / {variance} END)))"""


def _kmeans(name: str, source: str, k: int, rounds: int, seed: int) -> list[tuple[str, str]]:
    """Tables ``<name>_a`` (id, vec, cluster) and ``<name>_s`` (cluster, n, mean, mean_square)."""
    order = f"md5('{seed}:' || id), id"
    tables = [
        (
            f"{name}_s0",
            f"""SELECT row_number() OVER (ORDER BY {order}) - 1 AS cluster, 0 AS n, vec AS mean,
                       list_transform(vec, lambda v: v * v) AS mean_square
                FROM {source} ORDER BY {order} LIMIT {k}""",
        )
    ]
    for i in range(1, rounds + 1):
        last = "" if i == rounds else str(i)
        tables.append((
            f"{name}_a{last}",
            f"""SELECT id, vec, arg_min(cluster, list_distance(vec, mean)) AS cluster
                FROM {source}, {name}_s{i - 1} GROUP BY id, vec""",
        ))
        tables.append((
            f"{name}_s{last}",
            f"""SELECT s.cluster, coalesce(m.n, 0) AS n, coalesce(m.mean, s.mean) AS mean,
                       coalesce(m.mean_square, list_transform(s.mean, lambda v: v * v)) AS mean_square
                FROM {name}_s{i - 1} s LEFT JOIN (
                  SELECT cluster, any_value(n) AS n, list(m ORDER BY pos) AS mean,
                         list(q ORDER BY pos) AS mean_square
                  FROM (SELECT cluster, pos, count(*) AS n, avg(x) AS m, avg(x * x) AS q
                        FROM (SELECT cluster, unnest(vec) AS x, unnest(range(len(vec))) AS pos
                              FROM {name}_a{last}) GROUP BY cluster, pos)
                  GROUP BY cluster) m USING (cluster)""",
        ))
    return tables


def _combined(rows: str, key: str) -> str:
    """Clusters of ``rows (key, n, mean, mean_square)`` added up per key."""
    return f"""
      SELECT {key}, any_value(n) AS n, list(mean ORDER BY pos) AS mean,
             list(mean_square ORDER BY pos) AS mean_square
      FROM (SELECT {key}, pos, sum(n) AS n, sum(n * m) / sum(n) AS mean,
                   sum(n * q) / sum(n) AS mean_square
            FROM (SELECT {key}, n, unnest(mean) AS m, unnest(mean_square) AS q,
                         unnest(range(len(mean))) AS pos FROM ({rows}))
            GROUP BY {key}, pos)
      GROUP BY {key}
    """


def bfr_tables(
    points: str, k: int, alpha: float, dimensions: int, chunks: int, seed: int
) -> list[tuple[str, str]]:
    """Named tables up to ``labels`` and ``rounds``; ``points`` yields (id, vec)."""
    limit = alpha * dimensions**0.5
    tables = [
        ("points", points),
        ("chunked", f"""SELECT id, vec, CAST(floor(id * {chunks} / (SELECT max(id) + 1 FROM points))
                        AS BIGINT) AS chunk FROM points"""),
        ("sized", f"""SELECT CASE WHEN count(*) > {SAMPLE_POINTS} THEN {SAMPLE_POINTS}
                      ELSE CAST(floor(count(*) * {SAMPLE_SHARE}) AS BIGINT) END AS first
                      FROM chunked WHERE chunk = 0"""),
        ("sample", "SELECT id, vec FROM chunked, sized WHERE chunk = 0 AND id < first"),
        ("pool0", "SELECT id, vec FROM chunked, sized WHERE chunk = 0 AND id >= first"),
        *_kmeans("k", "sample", k, DISCARD_ROUNDS, seed),
        *_kmeans("c0", "pool0", k * CLUSTER_FACTOR, FIRST_REST_ROUNDS, seed),
        ("ds0", "SELECT cluster AS key, n, mean, mean_square FROM k_s"),
        ("cs0", f"SELECT cluster + {ROUND_BASE} AS key, n, mean, mean_square FROM c0_s WHERE n > 1"),
        ("rs0", "SELECT id, vec FROM c0_a JOIN c0_s USING (cluster) WHERE n = 1"),
    ]
    owners = [
        "SELECT id, cluster AS key FROM k_a",
        f"SELECT id, cluster + {ROUND_BASE} AS key FROM c0_a JOIN c0_s USING (cluster) WHERE n > 1",
    ]
    for r in range(1, chunks):
        base = ROUND_BASE * (r + 1)
        near = _distance("vec", "mean", "mean_square")
        tables += [
            (f"chunk{r}", f"SELECT id, vec FROM chunked WHERE chunk = {r}"),
            (f"near{r}", f"""
              SELECT id, key, distance, clusters
              FROM (SELECT id, key, {near} AS distance, clusters
                    FROM chunk{r}, (SELECT *, 0 AS clusters FROM ds{r - 1}
                                    UNION ALL SELECT *, 1 FROM cs{r - 1}))
              WHERE distance < {limit}"""),
            (f"placed{r}", f"""
              SELECT id, vec, key FROM (
                SELECT id, key, row_number() OVER (
                  PARTITION BY id ORDER BY clusters, distance, key) AS place FROM near{r})
              JOIN chunk{r} USING (id) WHERE place = 1"""),
            (f"grown{r}", _combined(
                f"""SELECT * FROM ds{r - 1} WHERE n > 0 UNION ALL SELECT * FROM cs{r - 1}
                    UNION ALL SELECT key, 1, vec, list_transform(vec, lambda v: v * v)
                    FROM placed{r}""", "key")),
            (f"pool{r}", f"""SELECT id, vec FROM chunk{r} ANTI JOIN placed{r} USING (id)
                             UNION ALL SELECT id, vec FROM rs{r - 1}"""),
            *_kmeans(f"c{r}", f"pool{r}", k * CLUSTER_FACTOR, RETAINED_ROUNDS, seed),
            (f"ds{r}", f"""SELECT d.key, coalesce(g.n, d.n) AS n, coalesce(g.mean, d.mean) AS mean,
                                  coalesce(g.mean_square, d.mean_square) AS mean_square
                           FROM ds{r - 1} d LEFT JOIN grown{r} g USING (key)"""),
            (f"open{r}", f"""SELECT * FROM grown{r} WHERE key >= {ROUND_BASE}
                             UNION ALL SELECT cluster + {base}, n, mean, mean_square
                             FROM c{r}_s WHERE n > 1"""),
            (f"rs{r}", f"SELECT id, vec FROM c{r}_a JOIN c{r}_s USING (cluster) WHERE n = 1"),
            (f"pairs{r}", f"""
              SELECT row_number() OVER (ORDER BY a.key, b.key) AS place, a.key AS x, b.key AS y
              FROM open{r} a JOIN open{r} b ON a.key < b.key
              WHERE {_distance('b.mean', 'a.mean', 'a.mean_square')} < {limit}"""),
            (f"greedy{r}(place, used)", f"""
              SELECT CAST(0 AS BIGINT), []::BIGINT[]
              UNION ALL
              SELECT p.place, CASE WHEN list_contains(used, x) OR list_contains(used, y) THEN used
                                   ELSE list_concat(used, [x, y]) END
              FROM greedy{r} g JOIN pairs{r} p ON p.place = g.place + 1"""),
            (f"moved{r}", f"""
              SELECT unnest(used) AS key,
                     {base + MERGED_BASE} + (unnest(range(len(used))) // 2) AS target
              FROM (SELECT used FROM greedy{r} ORDER BY place DESC LIMIT 1)"""),
            (f"cs{r}", _combined(
                f"""SELECT coalesce(target, key) AS key, n, mean, mean_square
                    FROM open{r} LEFT JOIN moved{r} USING (key)""", "key")),
        ]
        owners += [
            f"SELECT id, key FROM placed{r}",
            f"SELECT id, cluster + {base} AS key FROM c{r}_a JOIN c{r}_s USING (cluster) WHERE n > 1",
        ]
    last = chunks - 1
    tables += [
        ("joining", f"""
          SELECT key, min(target) AS target FROM (
            SELECT c.key, d.key AS target,
                   {_distance('c.mean', 'd.mean', 'd.mean_square')} AS distance
            FROM cs{last} c, ds{last} d)
          WHERE distance < {limit} GROUP BY key"""),
        ("owner0", " UNION ALL ".join(owners)),
    ]
    for r in range(1, chunks):
        tables.append((f"owner{r}", f"""SELECT id, coalesce(target, key) AS key
                                        FROM owner{r - 1} LEFT JOIN moved{r} USING (key)"""))
    tables.append(("labels", f"""
      SELECT id, CAST(CASE WHEN coalesce(target, key) < {ROUND_BASE} THEN coalesce(target, key)
                           ELSE -1 END AS INTEGER) AS cluster
      FROM owner{last} LEFT JOIN joining USING (key)
      UNION ALL SELECT id, -1 FROM rs{last}"""))
    records = []
    for r in range(chunks):
        joined = "(SELECT coalesce(sum(n), 0) FROM cs%d JOIN joining USING (key))" % r
        gone = "(SELECT count(*) FROM joining)"
        end = r == last
        records.append(f"""
          SELECT CAST({r + 1} AS INTEGER) AS round_id,
            CAST((SELECT count(*) FROM ds{r}) AS INTEGER) AS nof_cluster_discard,
            CAST((SELECT sum(n) FROM ds{r}) + {joined if end else 0} AS BIGINT)
              AS nof_point_discard,
            CAST((SELECT count(*) FROM cs{r}) - {gone if end else 0} AS INTEGER)
              AS nof_cluster_compression,
            CAST((SELECT coalesce(sum(n), 0) FROM cs{r}) - {joined if end else 0} AS BIGINT)
              AS nof_point_compression,
            CAST((SELECT count(*) FROM rs{r}) AS BIGINT) AS nof_point_retained""")
    tables.append(("rounds", " UNION ALL ".join(records)))
    return tables


def statement(tables: list[tuple[str, str]], result: str) -> str:
    parts = [f"{name} AS {'' if '(' in name else 'MATERIALIZED '}({sql})" for name, sql in tables]
    return f"WITH RECURSIVE {', '.join(parts)} SELECT * FROM {result}"
