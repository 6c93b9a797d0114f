"""Pieces of SQL text shared by the oracles.

Rounded figures use integer arithmetic on cents, which rounds halves up exactly.
"""

OK, BAD, PENDING = "status = 'Success'", "status = 'Failed'", "status = 'Pending'"


def n(where=None, name=None):
    out = f"count(*) FILTER (WHERE {where})" if where else "count(*)"
    return f"{out} AS {name}" if name else out


def money(value, where=None, zero=False):
    """A sum as DOUBLE."""
    out = f"sum({value})" + (f" FILTER (WHERE {where})" if where else "")
    return f"CAST(coalesce({out}, 0) AS DOUBLE)" if zero else f"CAST({out} AS DOUBLE)"


def half_up(top, bottom, places):
    """``top / bottom`` (both integers, not negative) rounded to ``places``."""
    unit = 10 ** places
    return (f"CAST((2 * CAST(({top}) AS HUGEINT) * {unit} + ({bottom})) "
            f"// nullif(2 * CAST(({bottom}) AS HUGEINT), 0) AS DOUBLE) / {unit}")


def pct(hit, of=None, places=2):
    return half_up(f"100 * {n(hit)}", n(of), places)


def avg2(value="amount", where=None, places=2):
    """Mean of a column with two decimals, rounded."""
    f = f" FILTER (WHERE {where})" if where else ""
    top = f"CAST(coalesce(sum({value}){f}, 0) * 100 AS HUGEINT)"
    unit = 10 ** (places - 2) if places >= 2 else None
    count = f"count({value}){f}"
    if unit is None:
        raise ValueError(places)
    return (f"CAST((2 * {top} * {unit} + {count}) // nullif(2 * {count}, 0) AS DOUBLE)"
            f" / {10 ** places}")


def avg(value="amount", where=None):
    """Mean, unrounded."""
    f = f" FILTER (WHERE {where})" if where else ""
    return f"(CAST(sum({value}){f} AS DOUBLE) / nullif(count({value}){f}, 0))"


def share(hit, of=None, scale=100):
    """Rows meeting ``hit`` per row meeting ``of``, unrounded."""
    out = f"(CAST({n(hit)} AS DOUBLE) / nullif({n(of)}, 0))"
    return f"({out} * {scale})" if scale != 1 else out
