import math


def plain(value):
    """A value that compares across engines."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def rows_of(rows, columns):
    return sorted(repr(tuple(plain(r[c]) for c in columns)) for r in rows)


def same_rows(spark_df, duck, sql):
    """Assert that a DataFrame and a SQL text have the same columns and rows."""
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    assert sorted(names) == sorted(spark_df.columns)
    columns = sorted(names)
    assert rows_of([r.asDict() for r in spark_df.collect()], columns) == rows_of(expected, columns)
