"""DuckDB fragments shared by the oracle queries (the correctness twin of
the Spark expressions in ``lookout.functions`` and ``lookout.classes``)."""

from __future__ import annotations

from lookout.classes import CLASS_NAMES, NUM_CLASSES, UNKNOWN_NAME


def classes_cte() -> str:
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(CLASS_NAMES))
    return f"classes AS (SELECT * FROM (VALUES {rows}) t(class_id, class_name))"


def class_name(id_sql: str) -> str:
    """Id -> name, NULL when outside the dimension."""
    arr = "[" + ", ".join(f"'{n}'" for n in CLASS_NAMES) + "]"
    return f"(CASE WHEN ({id_sql}) BETWEEN 0 AND {len(CLASS_NAMES) - 1} THEN {arr}[({id_sql}) + 1] END)"


def class_label(id_sql: str) -> str:
    return f"coalesce({class_name(id_sql)}, '{UNKNOWN_NAME}')"


def short_label(name_sql: str) -> str:
    return f"(CASE WHEN instr({name_sql}, ': ') > 0 THEN split_part({name_sql}, ': ', 2) ELSE {name_sql} END)"


def status(id_sql: str) -> str:
    return f"(CASE WHEN ({id_sql}) = 0 THEN 'attentive' ELSE 'alert' END)"


def local_path(col: str, root: str = "/app") -> str:
    s1 = f"regexp_replace(regexp_replace(url_decode({col}), '^file:', ''), '^/+', '/')"
    s2 = (
        f"(CASE WHEN regexp_matches({s1}, '^[a-zA-Z]:/') "
        f"THEN concat('/mnt/', lower(substr({s1}, 1, 1)), '/', substr({s1}, 4)) ELSE {s1} END)"
    )
    s3 = f"(CASE WHEN starts_with({s2}, '/') THEN {s2} ELSE concat('{root.rstrip('/')}/', {s2}) END)"
    return f"(CASE WHEN {col} IS NOT NULL THEN replace({s3}, '\\', '/') END)"


def base_name(p: str) -> str:
    return f"regexp_extract({p}, '[^/]*$', 0)"


def suffix(p: str) -> str:
    return f"lower(regexp_extract({base_name(p)}, '.(\\.[^.]+)$', 1))"


def linear_sql(vec: str) -> str:
    """DuckDB twin of :func:`lookout.functions.arrays.linear_scores`."""
    return (
        f"list_transform(range({NUM_CLASSES}), lambda c: list_sum(list_transform(range(len({vec})), lambda i: "
        f"CAST({vec}[i + 1] AS DOUBLE) * (CAST(((7 * c + 3 * i) % 11) - 5 AS DOUBLE) / 10.0))) "
        f"+ CAST(c AS DOUBLE) / 100.0)"
    )
