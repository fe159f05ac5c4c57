"""DuckDB oracle text for the map queries: the batch rule unrolled as CTEs.

Given a source query with key columns and raw features, the generated CTEs
are ``b`` (bounds), ``z`` (scaled rows), ``cb0 .. cbE`` (codebooks) and
``a0 .. a{E}`` (best unit of every row against ``cb{e}``, ``rn = 1``; ``a{E}``
scores the final codebook and, with ``second``, keeps ``rn = 2`` too, folded
into ``sc``).  Distances are summed feature by feature in the same
order as the Spark kernel; ties go to the lowest ``(x, y)``.
"""

from __future__ import annotations

from ..operators.som.config import decay


def _h(kind: str, sigma: float) -> str:
    d = repr(2.0 * sigma * sigma)
    p = "((c.nx - s.bx) * (c.nx - s.bx) + (c.ny - s.by) * (c.ny - s.by))::DOUBLE"
    if kind == "gaussian":
        return f"exp(-{p} / {d})"
    if kind == "mexican_hat":
        return f"(exp(-{p} / {d}) * (1.0::DOUBLE - 2.0::DOUBLE * {p} / {d}))"
    if kind == "bubble":
        return (f"(CASE WHEN abs(c.nx - s.bx) < {sigma!r} AND abs(c.ny - s.by) < {sigma!r} "
                f"THEN 1.0 ELSE 0.0 END)::DOUBLE")
    if kind == "triangle":
        return (f"(greatest(0.0::DOUBLE, {sigma!r} - abs(c.nx - s.bx)) * "
                f"greatest(0.0::DOUBLE, {sigma!r} - abs(c.ny - s.by)))")
    raise ValueError(kind)


def som_ctes(src: str, keys: list[str], feats: list[str], x: int, y: int, epochs: int,
             sigma: float = 1.0, lr: float = 0.5, kind: str = "gaussian",
             decay_function: str = "asymptotic", second: bool = False, start: str | None = None) -> str:
    """``start``: CTEs that define ``cb0`` from ``z``, instead of the grid start."""
    d = len(feats)
    k = ", ".join(keys)
    zk = ", ".join(f"z.{c}" for c in keys)
    ctes = [f"src AS ({src})"]
    ctes.append("b AS (SELECT " + ", ".join(
        f"min({f}) AS mn{i}, max({f}) AS mx{i}" for i, f in enumerate(feats)) + " FROM src)")
    ctes.append(f"z AS (SELECT {k}, " + ", ".join(
        f"({f} - mn{i}) / (CASE WHEN mx{i} - mn{i} = 0 THEN 1.0::DOUBLE ELSE mx{i} - mn{i} END) AS z{i}"
        for i, f in enumerate(feats)) + " FROM src, b)")
    ctes.append(start or "cb0 AS (SELECT i::INTEGER AS nx, j::INTEGER AS ny, " + ", ".join(
        (f"(i::DOUBLE + 0.5::DOUBLE) / {x}::DOUBLE AS w{f}" if f % 2 == 0
         else f"(j::DOUBLE + 0.5::DOUBLE) / {y}::DOUBLE AS w{f}") for f in range(d))
        + f" FROM range({x}) t(i), range({y}) u(j))")
    d2 = " + ".join(f"(z.z{i} - c.w{i}) * (z.z{i} - c.w{i})" for i in range(d))
    zs = ", ".join(f"z{i}" for i in range(d))
    for e in range(epochs + 1):
        ctes.append(
            f"a{e} AS (SELECT * FROM (SELECT {zk}, "
            + ", ".join(f"z.z{i}" for i in range(d))
            + f", c.nx, c.ny, sqrt({d2}) AS dist, row_number() OVER "
            f"(PARTITION BY {zk} ORDER BY {d2}, c.nx, c.ny) AS rn FROM z, cb{e} c) "
            f"WHERE rn <= {2 if second and e == epochs else 1})")
        if e == epochs:
            break
        sg = decay(sigma, e, epochs, decay_function)
        ctes.append(f"s{e} AS (SELECT nx AS bx, ny AS by, count(*)::DOUBLE AS n, "
                    + ", ".join(f"sum(z{i}) AS s{i}" for i in range(d))
                    + f" FROM a{e} WHERE rn = 1 GROUP BY nx, ny)")
        h = _h(kind, sg)
        ctes.append(
            f"cb{e + 1} AS (SELECT nx, ny, " + ", ".join(
                f"CASE WHEN sum(abs(h) * n) > 0 THEN w{i} + {lr!r} * sum(h * (s{i} - n * w{i})) "
                f"/ sum(abs(h) * n) ELSE w{i} END AS w{i}" for i in range(d))
            + f" FROM (SELECT c.*, s.*, {h} AS h FROM cb{e} c, s{e} s) GROUP BY nx, ny, "
            + ", ".join(f"w{i}" for i in range(d)) + ")")
    if second:
        ctes.append(
            f"sc AS (SELECT {k}, max(CASE WHEN r = 1 THEN nx END) AS neuron_x, "
            f"max(CASE WHEN r = 1 THEN ny END) AS neuron_y, max(CASE WHEN r = 1 THEN dist END) AS distance, "
            f"max(CASE WHEN r = 2 THEN nx END) AS neuron2_x, max(CASE WHEN r = 2 THEN ny END) AS neuron2_y "
            f"FROM (SELECT *, rn AS r FROM a{epochs}) "
            f"GROUP BY {k})")
    return ("WITH RECURSIVE " if start else "WITH ") + ",\n".join(ctes) + "\n"


def pca_start(d: int, x: int, y: int, squarings: int = 50) -> str:
    """``cb0`` along the first two principal directions of ``z``; the covariance is a flat
    list, squared again and again."""
    cells = range(d * d)
    cov = ", ".join(f"covar_samp(z{e // d}, z{e % d})" for e in cells)
    square = f"""list_transform(range({d * d}), lambda e: list_sum(list_transform(range({d}), lambda t:
      m[e // {d} * {d} + t + 1] * m[t * {d} + e % {d} + 1])))"""
    unit = lambda name, src: f"""{name}r(step, m) AS (
  SELECT 0, m FROM {src} UNION ALL SELECT step + 1, {square} FROM (
    SELECT step, list_transform(m, lambda v: v / s) AS m FROM (
      SELECT step, m, list_max(list_transform(m, lambda v: abs(v))) AS s FROM {name}r WHERE step < {squarings}))),
{name}v AS (SELECT list_transform(range({d}), lambda i: list_sum(list_transform(range({d}), lambda t:
    m[i * {d} + t + 1] * (1.0::DOUBLE / (t + 1))))) AS v FROM {name}r WHERE step = {squarings}),
{name}n AS (SELECT list_transform(v, lambda a: a / sqrt(list_sum(list_transform(v, lambda b: b * b)))) AS v FROM {name}v),
{name} AS (SELECT CASE WHEN v[list_position(list_transform(v, lambda a: abs(a)), list_max(list_transform(v, lambda a: abs(a))))] < 0
                  THEN list_transform(v, lambda a: -a) ELSE v END AS v FROM {name}n)"""  # noqa: E731
    rest = ", ".join(f"m[{e + 1}] - l * v[{e // d + 1}] * v[{e % d + 1}]" for e in cells)
    quad = " + ".join(f"v[{e // d + 1}] * m[{e + 1}] * v[{e % d + 1}]" for e in cells)
    grid = ", ".join(f"(2.0::DOUBLE * i / {x - 1} - 1.0::DOUBLE) * p1.v[{f + 1}] + "
                     f"(2.0::DOUBLE * j / {y - 1} - 1.0::DOUBLE) * p2.v[{f + 1}] AS w{f}" for f in range(d))
    return f"""pc AS (SELECT [{cov}] AS m FROM z),
{unit('p1', 'pc')},
pd AS (SELECT [{rest}] AS m FROM (SELECT m, v, {quad} AS l FROM pc, p1)),
{unit('p2', 'pd')},
cb0 AS (SELECT i::INTEGER AS nx, j::INTEGER AS ny, {grid} FROM range({x}) t(i), range({y}) u(j), p1, p2)"""
