"""Records that fail to parse, told apart from the valid ones with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellum.schema import BLOCK_TYPES, SPAN_TYPES, WORD_COLUMNS, WORD_INTS

#: One CSV field: quoted with inner quotes doubled, or free of quotes and commas. Possessive, so that long fields need no stack.
FIELD = '(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
RECORD = rf"\A(?:{FIELD},)*+{FIELD}\z"
DIGITS = r"\A[0-9]+\z"


def one_of(types: tuple[str, ...], bare: str) -> str:
    """Pattern of the labels over these types, spelled exactly; bare holds those without a type, as alternatives."""
    return rf"\A(?:{bare}|[BI]-(?:{'|'.join(types)}))\z"


def not_above(low: Column, high: Column) -> Column:
    """Whether a string of ASCII digits stands for a number at most that of another, of any length."""
    a, b = (F.regexp_replace(x, "^0+(?=[0-9])", "") for x in (low, high))
    return (F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a <= b))


def value_rules(c: dict[str, Column]) -> list[tuple[str, str, Column]]:
    """(column, rule, holds) over the text columns of a record; the columns are null where blank."""
    number = lambda k: F.coalesce(c[k].rlike(DIGITS), F.lit(False))
    counts = [k for k in WORD_INTS if k != "mcid"]
    both = lambda a, b: ~(number(a) & number(b)) | not_above(c[a], c[b])
    return [
        *[(k, "digits", number(k)) for k in counts],
        ("page", "from 1", ~number("page") | c["page"].rlike("[1-9]")),
        ("x1", "from x0", both("x0", "x1")),
        ("bottom", "from top", both("top", "bottom")),
        ("mcid", "digits", c["mcid"].isNull() | c["mcid"].rlike(DIGITS)),
        ("rgb", "colour", c["rgb"].isNull() | c["rgb"].rlike(r"\A#[0-9A-Fa-f]{3,4}\z")),
        ("segment", "label", F.coalesce(c["segment"].rlike(one_of(BLOCK_TYPES, "O|I")), F.lit(False))),
        ("sequence", "label", c["sequence"].isNull() | c["sequence"].rlike(one_of(SPAN_TYPES, "O"))),
        *[(k, "64 bits", ~number(k) | not_above(c[k], F.lit(str((1 << 63) - 1)))) for k in WORD_INTS],
        ("text", "not empty", c["text"].isNotNull()),
        ("text", "characters", c["text"].isNull() | ~F.contains(c["text"], F.lit("�"))),
    ]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once a row: the optimizer copies no expression through a generator."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def check_records(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Rows of df with the record's 16 columns as nullable text in __fields, and its errors in the array __errors.

    An error has reason (quoting, columns or value), column and rule. Every rule is evaluated as a column expression in one
    pass; a record whose quoting or number of columns is wrong has no fields to judge, so only that error. A final carriage
    return is not part of the record; a null record is an empty one. Empty fields are null text, other than those of blanks
    alone, which count as blank for mcid, rgb and sequence.
    """
    line = F.regexp_replace(F.coalesce(F.col(raw), F.lit("")), r"\r\z", "")
    quoted = line.rlike(RECORD)
    parts = F.when(quoted, F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(rf",({FIELD})"), F.lit(1)))
    plain = F.transform(parts, lambda x: F.when(F.startswith(x, F.lit('"')), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    text = F.transform(plain, lambda x: F.nullif(x, F.lit("")))
    out = once(df, "__fields", text)
    whole = F.size("__fields") == len(WORD_COLUMNS)
    c = {k: F.when(whole, F.get("__fields", F.lit(i))) for i, k in enumerate(WORD_COLUMNS)}
    c |= {k: F.when(F.btrim(c[k]) != "", c[k]) for k in ("mcid", "rgb", "sequence")}
    error = lambda reason, column, rule: F.struct(F.lit(reason).alias("reason"), F.lit(column).alias("column"), F.lit(rule).alias("rule"))
    rules = [F.when(~holds, error("value", k, rule)) for k, rule, holds in value_rules(c)]
    errors = (
        F.when(F.col("__fields").isNull(), F.array(error("quoting", None, None)))
        .when(~whole, F.array(error("columns", None, None)))
        .otherwise(F.filter(F.array(*rules), lambda x: x.isNotNull()))
    )
    return once(out, "__errors", errors)


def split_records(df: DataFrame, raw: str = "raw", line_no: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of raw CSV records: the word columns typed, and the rows that fail with their reason and errors.

    Records whose line number is 1 are headers and belong to neither; a null line number is no header. valid keeps the
    columns of df that don't clash with a word column, rejected all of df plus reason (of the first failing check) and errors.
    Integers are typed BIGINT; one too large for that is an invalid value. Repeated rows are kept; an empty table gives
    two empty ones. Both results read df once each, from built-in expressions alone.
    """
    checked = check_records(df.where(F.col(line_no).isNull() | (F.col(line_no) > 1)), raw)
    fields = [F.get("__fields", F.lit(i)) for i in range(len(WORD_COLUMNS))]
    typed = [(F.expr(f"try_cast(btrim(get(__fields, {i})) AS BIGINT)") if k in WORD_INTS else fields[i]).alias(k) for i, k in enumerate(WORD_COLUMNS)]
    kept = [F.col(k) for k in df.columns if k not in WORD_COLUMNS]
    valid = checked.where(F.size("__errors") == 0).select(*kept, *typed)
    rejected = checked.where(F.size("__errors") > 0).select(*[F.col(k) for k in df.columns if k not in ("reason", "errors")], F.col("__errors")[0]["reason"].alias("reason"), F.col("__errors").alias("errors"))
    return valid, rejected
