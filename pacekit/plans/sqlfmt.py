"""DuckDB twins of the display formats (for oracle SQL only)."""


def _s(x):
    return f"CAST(round_even(CAST({x} AS DOUBLE), 0) AS BIGINT)"


def time_sql(x):
    s = _s(x)
    return (f"CASE WHEN ({x}) IS NULL THEN '' WHEN {s} // 3600 <> 0 "
            f"THEN printf('%d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60) "
            f"ELSE printf('%d:%02d', ({s} % 3600) // 60, {s} % 60) END")


def pace_sql(x):
    s = _s(x)
    return f"CASE WHEN ({x}) IS NULL THEN '' ELSE printf('%d:%02d/km', {s} // 60, {s} % 60) END"


def signed_sql(x):
    s = f"abs({_s(x)})"
    return (f"CASE WHEN ({x}) IS NULL THEN '' ELSE printf('%s%d:%02d', CASE WHEN ({x}) > 0 THEN '+' ELSE '-' END, "
            f"{s} // 60, {s} % 60) END")


def speed_label_sql(x):
    return f"CASE WHEN ({x}) IS NULL THEN '' ELSE printf('%.2f km/h', {x}) END"
