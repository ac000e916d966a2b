"""Search conditions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.functions import paths, times
from trovelake.functions.errors import RequestError

# The operators of a metadata query.
OPERATORS = ("=", "like", "not like", "in", ">", "<", "n>", "n<", ">=", "<=", "n>=", "n<=")

INVALID_OPERATOR = "unknown operator; known are [" + ", ".join(OPERATORS) + "]"


def valid_operator(operator: str | None) -> str:
    """Canonical form of an operator, '=' where none is given."""
    found = "=" if operator is None else operator.lower()
    if found not in OPERATORS:
        raise RequestError(INVALID_OPERATOR)
    return found


def operator_of(operator: Column) -> Column:
    """Canonical operator column; NULL for an unknown operator."""
    lowered = F.coalesce(F.lower(operator), F.lit("="))
    return F.when(lowered.isin(*OPERATORS), lowered)


def like_pattern(pattern: Column) -> Column:
    """A LIKE pattern in which a backslash before anything but a wildcard or a
    backslash stands for itself, so that every text is a pattern."""
    return F.regexp_replace(pattern, r"(\\[%_\\])|(\\)", "$1$2$2")


# Text that is a number, and one that fits a decimal without loss.
NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+-]?[0-9]{1,38}\s*$"


def compared_as_numbers(symbol: str, actual: Column, wanted: Column) -> Column:
    """Whole numbers are compared exactly, others in double precision; text that
    is no number, such as NaN or 5d, never matches."""
    whole = actual.rlike(WHOLE) & wanted.rlike(WHOLE)
    exact = compared(symbol, *(c.try_cast("decimal(38,0)") for c in (actual, wanted)))
    double = compared(symbol, *(
        F.when(c.rlike(NUMBER), c.try_cast("double")) for c in (actual, wanted)))
    return F.when(whole, exact).otherwise(double)


def compared(operator: str, actual: Column, wanted: Column) -> Column:
    """``actual <operator> wanted`` for one known operator.

    Plain comparisons are in text (UTF-8 byte) order. The ``n`` forms compare
    numbers; text that is no number never matches.
    """
    symbol = operator.lstrip("n") if operator.startswith("n") and operator[1] in "<>" else operator
    if symbol != operator:
        return compared_as_numbers(symbol, actual, wanted)
    return {
        "=": lambda: actual == wanted,
        "like": lambda: F.like(actual, like_pattern(wanted)),
        "not like": lambda: ~F.like(actual, like_pattern(wanted)),
        ">": lambda: actual > wanted,
        "<": lambda: actual < wanted,
        ">=": lambda: actual >= wanted,
        "<=": lambda: actual <= wanted,
    }[symbol]()


def compared_by(operator: Column, actual: Column, value: Column, values: Column) -> Column:
    """The same with the operator in a column; used when clauses are rows."""
    test = F.when(operator == "in", F.array_contains(values, actual))
    for name in OPERATORS:
        if name != "in":
            test = test.when(operator == name, compared(name, actual, value))
    return F.coalesce(test, F.lit(False))


@dataclass(frozen=True)
class Clause:
    """``attribute <operator> value``; units take no part in a search."""

    attribute: str
    value: str | tuple[str, ...]
    operator: str = "="

    @classmethod
    def of(cls, document: dict) -> Clause:
        attribute = document.get("attribute", document.get("a"))
        value = document.get("value", document.get("v"))
        operator = valid_operator(document.get("operator", document.get("o")))
        if not isinstance(attribute, str):
            raise RequestError("an AVU needs an attribute that is a text")
        if operator == "in":
            if not isinstance(value, list) or not all(isinstance(v, str) for v in value):
                raise RequestError("the operator 'in' takes a list of texts")
            return cls(attribute, tuple(value), operator)
        if not isinstance(value, str):
            raise RequestError("an AVU needs a value that is a text")
        return cls(attribute, value, operator)

    def condition(self) -> Column:
        """The attribute test is a conjunct of its own, so that it is pushed
        down even where the value test cannot be."""
        value = F.col("value")
        test = (
            value.isin(*self.value) if self.operator == "in"
            else compared(self.operator, value, F.lit(self.value))
        )
        return (F.col("attribute") == self.attribute) & F.coalesce(test, F.lit(False))


@dataclass(frozen=True)
class TimeClause:
    """``created|modified <operator> time``; every operator compares times."""

    field: str
    at: str
    operator: str = "="

    @classmethod
    def of(cls, document: dict) -> TimeClause:
        created = document.get("created", document.get("c"))
        modified = document.get("modified", document.get("m"))
        if created is None and modified is None:
            raise RequestError("a time clause names created or modified")
        operator = valid_operator(document.get("operator", document.get("o")))
        if operator in ("like", "not like", "in"):
            raise RequestError(f"times cannot be compared with '{operator}'")
        field = "modified" if created is None else "created"
        return cls(field, modified if created is None else created, operator)

    def condition(self) -> Column:
        wanted = times.to_timestamp(F.lit(self.at))
        return compared(self.operator.lstrip("n"), F.col(self.field), wanted)


def time_compared_by(operator: Column, actual: Column, wanted: Column) -> Column:
    plain = F.regexp_replace(operator, "^n", "")
    test = F.when(plain == "=", actual == wanted)
    for name in (">", "<", ">=", "<="):
        test = test.when(plain == name, compared(name, actual, wanted))
    return F.coalesce(test, F.lit(False))


def where_attribute(rows: DataFrame, attribute: str) -> DataFrame:
    """List metadata restricted to one attribute."""
    return rows.where(F.col("attribute") == attribute)


def where_owner(acls: DataFrame, owner: str, level: str | None = None) -> DataFrame:
    """Entries of one owner, at exactly one level if given; any owner zone."""
    acls = acls.where(F.col("owner") == owner)
    return acls if level is None else acls.where(F.col("level") == level.lower())


def in_scope(rows: DataFrame, collection: str | None, zone: str | None,
             scope: str = "prefix") -> DataFrame:
    """Restrict to a zone, or to what lies under a collection.

    ``/zone`` alone only names the zone; a zone given explicitly wins over it.
    """
    if collection is not None:
        root = collection.rstrip("/") or "/"
        if root.count("/") == 1 and len(root) > 1 and root.startswith("/"):
            zone = zone or root[1:]
        elif root.startswith("/"):
            rows = rows.where(paths.under(F.col("coll_path"), F.lit(root), scope))
        else:
            raise RequestError(f"Path '{root}' is not absolute")
    return rows if zone is None else rows.where(F.col("zone") == zone)
