"""DuckDB oracle text for k-means: seeding rounds and Lloyd steps unrolled as CTEs.

Needs a CTE ``kz`` with ``key`` (text), ``w`` and ``z0, z1, ...``; gives ``cen`` (k, c,
centers ``m0, m1, ...``) and ``fin`` (k, key, c, w, d2: nearest center of every row).
"""

from __future__ import annotations


def _d2(a: str, b: str, d: int, x: str = "z", y: str = "z") -> str:
    return " + ".join(f"({a}.{x}{i} - {b}.{y}{i}) * ({a}.{x}{i} - {b}.{y}{i})" for i in range(d))


def _place(seed: int, e: int) -> str:
    return f"('0x' || substr(md5(key || ':{seed}:{e}'), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE"


def kmeans_ctes(d: int, ks: list[int], seed: int = 42, rounds: int = 2, oversampling: float = 2.0,
                iterations: int = 20) -> str:
    z = ", ".join(f"z{i}" for i in range(d))
    out = [f"kr AS (SELECT key, w, {z} FROM kz WHERE w > 0)",
           f"kc0 AS (SELECT 0 AS rnd, key, {z} FROM kr ORDER BY {_place(seed, -1)}, key LIMIT 1)"]
    for e in range(rounds):
        out.append(f"kd{e} AS (SELECT r.key, any_value(r.w) AS w, {', '.join(f'any_value(r.z{i}) AS z{i}' for i in range(d))}, "
                   f"min({_d2('r', 'c', d)}) AS d2 FROM kr r, kc{e} c GROUP BY r.key)")
        out.append(f"kc{e + 1} AS (SELECT * FROM kc{e} UNION ALL SELECT {e + 1}, key, {z} FROM kd{e} "
                   f"WHERE {_place(seed, e)} < {oversampling * max(ks)!r}::DOUBLE / (SELECT sum(w * d2) FROM kd{e}) * w * d2)")
    out.append(f"kn AS (SELECT row_number() OVER (ORDER BY rnd, key) - 1 AS i, {z} FROM kc{rounds})")
    out.append(f"ka AS (SELECT r.key, any_value(r.w) AS w, arg_min(n.i, {{'d': {_d2('r', 'n', d)}, 'i': n.i}}) AS i "
               "FROM kr r, kn n GROUP BY r.key)")
    out.append(f"kw AS (SELECT n.i, {', '.join(f'n.z{i}' for i in range(d))}, coalesce(any_value(s.w), 0.0) AS w "
               f"FROM kn n LEFT JOIN (SELECT i, sum(w) AS w FROM ka GROUP BY i) s ON s.i = n.i "
               f"GROUP BY n.i, {', '.join(f'n.z{i}' for i in range(d))})")
    out.append(f"ks0 AS (SELECT 0 AS c, {z} FROM kw ORDER BY w DESC, i LIMIT 1)")
    for j in range(1, max(ks)):
        out.append(f"ks{j} AS (SELECT * FROM ks{j - 1} UNION ALL (SELECT {j}, {z} FROM ("
                   f"SELECT n.i, any_value(n.w) AS w, {', '.join(f'any_value(n.z{i}) AS z{i}' for i in range(d))}, "
                   f"min({_d2('n', 's', d)}) AS d2 FROM kw n, ks{j - 1} s GROUP BY n.i) "
                   "WHERE w * d2 > 0 ORDER BY w * d2 DESC, i LIMIT 1))")
    m = ", ".join(f"s.z{i} AS m{i}" for i in range(d))
    out.append(f"cen0 AS (SELECT k, s.c, {m} FROM ks{max(ks) - 1} s, (SELECT unnest({list(ks)}) AS k) WHERE s.c < k)")
    near = (f"(SELECT c.k, r.key, any_value(r.w) AS w, {', '.join(f'any_value(r.z{i}) AS z{i}' for i in range(d))}, "
            "arg_min(c.c, {{'d': {d2}, 'c': c.c}}) AS c, min({d2}) AS d2 FROM {rows} r, {cen} c GROUP BY c.k, r.key)")
    d2 = _d2("r", "c", d, "z", "m")
    for t in range(iterations):
        mean = ", ".join(f"CASE WHEN sum(a.w) > 0 THEN sum(a.w * a.z{i}) / sum(a.w) ELSE any_value(c.m{i}) END AS m{i}"
                         for i in range(d))
        out.append(f"near{t} AS MATERIALIZED {near.format(d2=d2, rows='kr', cen=f'cen{t}')}")
        out.append(f"cen{t + 1} AS MATERIALIZED (SELECT c.k, c.c, {mean} FROM cen{t} c "
                   f"LEFT JOIN near{t} a ON a.k = c.k AND a.c = c.c GROUP BY c.k, c.c)")
    out.append(f"cen AS (SELECT * FROM cen{iterations})")
    out.append(f"fin AS {near.format(d2=d2, rows='kz', cen='cen')}")
    return ",\n".join(out) + "\n"
