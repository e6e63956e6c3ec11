import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loadkit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, shuffle_partitions=2)
    # The frames are tiny, so compiling and re-planning would be most of the time.
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    if isinstance(value, date):
        return f"DATE'{value}'"
    return str(value)


def inline(spark, schema, rows):
    """A local frame from a DDL schema and rows, without a Python job behind each scan."""
    fields = [part.strip().split(" ") for part in schema.split(", ")]
    names = ", ".join(f"CAST(c{i} AS {kind}) AS `{name}`" for i, (name, kind) in enumerate(fields))
    given = rows or [[None] * len(fields)]
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in given)
    columns = ", ".join(f"c{i}" for i in range(len(fields)))
    out = spark.sql(f"SELECT {names} FROM VALUES {body} AS t({columns})")
    return out if rows else out.where("false")


@pytest.fixture
def frame(spark):
    """A frame from a DDL schema and rows."""
    return lambda schema, *rows: inline(spark, schema, rows)


def bag(df, *columns):
    """Rows as a sorted list of plain tuples, decimals as floats."""
    from decimal import Decimal
    rows = df.select(*columns).collect() if columns else df.collect()
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))
