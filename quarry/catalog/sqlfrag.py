"""SQL fragments shared by oracle texts."""


def py_round(expr: str, digits: int) -> str:
    """DuckDB text for Python's round(x, digits) on a double: the exact binary value is
    rounded; only exact ties go half-even. Mirrors ``functions.numeric.round_exact``.

    Values within 1e-6 of a half step are settled exactly: x = m * 2^e is compared with the
    decimal midpoint (2k + 1) / (2 * 10^digits) as integers."""
    v = f"({expr})"
    ax = f"abs{v}"
    p = 10 ** digits
    k = f"floor({ax} * {p})"
    near = f"(abs({ax} * {p} - {k} - 0.5) < 1e-6)"
    e = f"(CAST(floor(log2({ax})) AS INTEGER) - 54)"
    lhs = f"(CAST({ax} / pow(2.0, {e}) AS HUGEINT) * {2 * p})"
    rhs = f"(CAST(2 * {k} + 1 AS HUGEINT) * CAST(pow(2.0, -{e}) AS HUGEINT))"
    up = f"sign{v} * CAST({k} + 1 AS DOUBLE) / {p}.0"
    down = f"sign{v} * CAST({k} AS DOUBLE) / {p}.0"
    return (f"(CASE WHEN {v} IS NULL OR isnan({v}) THEN {v} "
            f"WHEN {near} AND {lhs} > {rhs} THEN {up} "
            f"WHEN {near} AND {lhs} < {rhs} THEN {down} "
            f"WHEN {near} THEN (CASE WHEN CAST({k} AS HUGEINT) % 2 = 0 THEN {down} ELSE {up} END) "
            f"ELSE round({v}, {digits}) END)")


def stable_round(expr: str, digits: int) -> str:
    """DuckDB text: round through DECIMAL(30, 8) so float noise of either engine (an ulp
    either side of a decimal tie) does not flip the last digit. Mirrors
    ``catalog.present.stable_round``."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(30,8)), {digits}) AS DOUBLE)"
