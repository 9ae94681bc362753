"""Validation rules as arrays of messages, and counts over them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftloom import constants as C
from siftloom.functions.rows import settled
from siftloom.functions.text import is_blank
from siftloom.functions.tokens import count_tokens, sample_tokens

# fixed values: the required fields, and below the texts of all messages
PLAIN_REQUIRED = ("instruction", "input", "output", "language", "license")
SAMPLE_REQUIRED = ("id", "dataset", "language", "license", "instruction", "output")


def _messages(*candidates: Column) -> Column:
    return F.array_compact(F.array(*candidates)) if candidates else _none()


def _none() -> Column:
    return F.array().cast("array<string>")


def _first_stage(*stages: Column) -> Column:
    """The first non-empty message list; later stages run only if earlier ones are empty."""
    *early, last = stages
    result = last
    for stage in reversed(early):
        result = F.when(F.size(stage) > 0, stage).otherwise(result)
    return result


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def with_tokens(df: DataFrame, counter=count_tokens, into: str = "token_count") -> DataFrame:
    return df.withColumn(into, sample_tokens(counter))


def sample_errors(df: DataFrame, tokens: str = "token_count", min_tokens: int = C.MIN_TOKENS,
                  max_tokens: int = C.MAX_TOKENS) -> Column:
    """Messages of the main validation: fields, then types, then content.

    Whether a field exists or is text is a property of the frame, so those
    messages are constants; a null counts as not being text.
    """
    missing = [F.lit(f"Missing field: {n}") for n in PLAIN_REQUIRED if n not in df.columns]
    if missing:
        return F.array(*missing)
    wrong = [F.when(F.col(n).isNull() if _is_text(df, n) else F.lit(True),
                    F.lit(f"{n} must be str")) for n in PLAIN_REQUIRED]
    total = F.col(tokens)
    content = _messages(
        F.when(is_blank(F.col("instruction")), F.lit("Instruction empty")),
        F.when(is_blank(F.col("output")), F.lit("Output empty")),
        F.when(~F.is_valid_utf8(F.col("output")), F.lit("Invalid UTF-8")),
        F.when(total > max_tokens, F.format_string("Too many tokens (%d)", total)),
        F.when(total < min_tokens, F.format_string("Too few tokens (%d)", total)),
    )
    return _first_stage(_messages(*wrong), content)


def error_code(message: Column) -> Column:
    """Message without embedded numbers, for grouping."""
    return F.regexp_replace(message, r" \([0-9]+\)$", "")


def is_valid(errors: Column) -> Column:
    return F.size(errors) == 0


def schema_errors() -> Column:
    """Messages of the schema-level check; they accumulate."""
    language, license_name = F.col("language"), F.col("license")
    required = [F.when(F.coalesce(is_blank(F.col(n)), F.lit(True)),
                       F.lit(f"Field '{n}' must be non-empty string")) for n in SAMPLE_REQUIRED]
    return _messages(
        *required,
        F.when(~F.lower(language).isin(*C.SUPPORTED_LANGUAGES),
               F.concat(F.lit("Language '"), language, F.lit("' not in supported list"))),
        F.when(F.lower(license_name).isin(*C.UNSPECIFIED_LICENSES),
               F.lit("License should be specified if available")),
        F.when(F.coalesce(is_blank(F.col("output")), F.lit(True)),
               F.lit("Output cannot be empty")),
    )


def detailed_errors(df: DataFrame, tokens: str = "token_count",
                    max_tokens: int = C.MAX_TOKENS) -> Column:
    """Errors of the detailed validation; each stage runs only after the one before is clean."""
    fields = []
    for name in SAMPLE_REQUIRED:
        if name not in df.columns:
            fields.append(F.lit(f"Missing required field: {name}"))
        elif not _is_text(df, name):
            got = df.schema[name].dataType.simpleString()
            fields.append(F.lit(f"Field '{name}' must be string, got {got}"))
        else:
            column = F.col(name)
            fields.append(
                F.when(column.isNull(), F.lit(f"Field '{name}' must be string, got null"))
                .when(is_blank(column), F.lit(f"Field '{name}' is empty")))
    encoding = [F.when(~F.is_valid_utf8(F.col(n)), F.lit(f"Field '{n}' contains invalid UTF-8"))
                for n in ("instruction", "input", "output") if n in df.columns]
    shape = []
    for name, kind, label in (("metadata", T.MapType, "dict"), ("tests", T.ArrayType, "list")):
        if name in df.columns and not isinstance(df.schema[name].dataType, kind):
            got = df.schema[name].dataType.simpleString()
            shape.append(F.lit(f"{name.capitalize()} must be {label}, got {got}"))
    total = F.col(tokens)
    too_long = F.when(total > max_tokens,
                      F.format_string(f"Sample exceeds max tokens (%d > {max_tokens})", total))
    return _first_stage(_messages(*fields), _messages(*encoding), _messages(too_long, *shape))


def detailed_warnings(early_errors: Column, tokens: str = "token_count",
                      min_tokens: int = C.MIN_TOKENS) -> Column:
    """Warnings; a sample that failed an early stage has none."""
    language, total = F.col("language"), F.col(tokens)
    known = F.lower(language).isin(*C.SUPPORTED_LANGUAGES, C.UNKNOWN)
    found = _messages(
        F.when(~known, F.concat(F.lit("Language '"), language,
                                F.lit("' not in supported list"))),
        F.when(total < min_tokens, F.format_string(
            f"Sample is very short (%d tokens, min {min_tokens})", total)),
    )
    return F.when(early_errors, _none()).otherwise(found)


def with_detailed_validation(df: DataFrame, counter=count_tokens, min_tokens: int = C.MIN_TOKENS,
                             max_tokens: int = C.MAX_TOKENS) -> DataFrame:
    """Add token_count, errors, warnings and is_valid."""
    counted = df if "token_count" in df.columns else with_tokens(df, counter)
    judged = counted.withColumn("errors", detailed_errors(counted, max_tokens=max_tokens))
    late = F.coalesce(F.startswith(F.get("errors", F.lit(0)), F.lit("Sample exceeds")),
                      F.lit(False))
    early = (F.size("errors") > 0) & ~late
    full = judged.withColumns({
        "warnings": detailed_warnings(early, min_tokens=min_tokens),
        "is_valid": is_valid(F.col("errors")),
    })
    return settled(full, "errors", "warnings", "is_valid")


def top_messages(errors: int = 3, warnings: int = 2) -> list:
    """The first few messages of a row, as shown in a short report."""
    return [F.slice("errors", 1, errors).alias("errors"),
            F.slice("warnings", 1, warnings).alias("warnings")]


def validation_summary(validated: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, valid_percent."""
    total, valid = F.count("*"), F.count_if("is_valid")
    return validated.agg(
        total.alias("total"), valid.alias("valid"), (total - valid).alias("invalid"),
        F.round(F.when(total > 0, valid * 100.0 / total).otherwise(0.0), 6)
        .alias("valid_percent"))


def validation_messages(validated: DataFrame, order: str = "pos", limit: int = 20) -> DataFrame:
    """The first error messages of the batch in sample order."""
    return (validated.where("NOT is_valid")
            .select(order, F.posexplode("errors").alias("error_no", "error"))
            .orderBy(order, "error_no").limit(limit)
            .select(order, "error_no",
                    F.concat(F.lit("Sample "), F.col(order), F.lit(": "), F.col("error"))
                    .alias("message")))


def message_types(validated: DataFrame) -> DataFrame:
    """Count of errors and warnings by type, the text before the first colon."""
    stacked = validated.select(F.explode(F.concat(
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("kind"), m.alias("message"))),
        F.transform("warnings",
                    lambda m: F.struct(F.lit("warning").alias("kind"), m.alias("message"))),
    )).alias("m"))
    return (stacked.groupBy(F.col("m.kind").alias("kind"),
                            F.substring_index("m.message", ":", 1).alias("type"))
            .agg(F.count("*").alias("n")))
