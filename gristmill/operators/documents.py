"""Document-store operations as functions from one snapshot to the next.

Tables of files do not change in place: each operation returns a new frame, and
``gristmill.sinks.write_snapshot`` stores it. Conditions are ordinary Columns; a null
condition does not match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID = "_id"


def insert(documents: DataFrame, new: DataFrame) -> DataFrame:
    """Add documents; fields that either side lacks are null."""
    return documents.unionByName(new, allowMissingColumns=True)


def find(
    documents: DataFrame,
    condition: Column | None = None,
    fields: Sequence[str] = (),
    sort: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    found = documents if condition is None else documents.filter(condition)
    if sort:
        found = found.orderBy(*sort, ID)
    if limit is not None:
        found = (found if sort else found.orderBy(ID)).limit(limit)
    return found.select(*fields) if fields else found


def matching(documents: DataFrame, condition: Column, one: bool) -> Column:
    """True on the documents to change: all that match, or of those only the one with the least id.

    That id is one value found by an aggregate, so no task ever holds all matches.
    """
    match = F.coalesce(condition, F.lit(False))
    if not one:
        return match
    return F.coalesce(F.col(ID) == documents.filter(condition).select(F.min(ID)).scalar(), F.lit(False))


def set_fields(documents: DataFrame, condition: Column, values: Mapping[str, Any], one: bool = False) -> DataFrame:
    """Give fields of the matching documents new values; a new field is null elsewhere."""
    match = matching(documents, condition, one)
    fields = {}
    for name, value in values.items():
        changed = F.when(match, value if isinstance(value, Column) else F.lit(value))
        fields[name] = changed.otherwise(F.col(name)) if name in documents.columns else changed
    return documents.withColumns(fields)


def increment(documents: DataFrame, condition: Column, amounts: Mapping[str, Any], one: bool = False) -> DataFrame:
    """Add to fields of the matching documents; a missing number counts as 0."""
    grown = {
        name: (F.coalesce(F.col(name), F.lit(0)) + F.lit(by)).cast(documents.schema[name].dataType)
        for name, by in amounts.items()
    }
    return set_fields(documents, condition, grown, one)


def delete(documents: DataFrame, condition: Column, one: bool = False) -> DataFrame:
    return documents.filter(~matching(documents, condition, one))


def aggregate(
    documents: DataFrame,
    group: Sequence[str],
    measures: Mapping[str, Column],
    match: Column | None = None,
    project: Sequence[Column | str] = (),
    sort: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Match, group, project, sort and limit in turn; equal rows come in group order."""
    result = documents if match is None else documents.filter(match)
    result = result.groupBy(*group).agg(*(column.alias(name) for name, column in measures.items()))
    if sort:
        result = result.orderBy(*sort, *group)
    if limit is not None:
        result = (result if sort else result.orderBy(*group)).limit(limit)
    return result.select(*project) if project else result
