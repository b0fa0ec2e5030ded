"""Small column helpers the operators share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the white space of the word rules, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores after it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` and the columns of ``ddl`` after it."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def row_key(name: str = "text") -> Column:
    """With doc_id, names a document: rows equal in both are the same document."""
    return F.xxhash64(text_or_empty(name))


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``names`` where NULL equals NULL; the right side's ``names`` are dropped."""
    other = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"_right_{n}"))
    return left.join(other, condition, how).drop(*[f"_right_{n}" for n in names])


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A never-NULL name of a document, by doc_id and text: rows equal in both are one document."""
    number = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.concat(number, F.lit(":"), row_key(text).cast("string"))
