"""Entity state folded from an ordered replication log.

Lines are (source_file, block, pos, line); their order is source_file, pos.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countermill.functions.text import delimited_field, last_field
from countermill.operators.ordering import previous

# What a line must contain, in the order it is tested.
EXPORTED, REMOVING, IMPORTED = "Exported SI_CUID", "Removing SI_CUID", "Imported SI_CUID"
IMPORT_ERROR = "Import Error"

EMPTY_ID_SALTS = 64


def replication_events(lines: DataFrame) -> DataFrame:
    """Events of a log: (at, kind, cuid, id, name, si_kind)."""
    line = F.col("line")
    kind = (
        F.when(line.contains(EXPORTED), "Exported")
        .when(line.contains(REMOVING), "Removing")
        .when(line.contains(IMPORTED), "Imported")
    )
    events = lines.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    # A Removing line has no id field, so name and kind come one place earlier.
    short = F.col("kind") == "Removing"
    field = lambda i: F.when(short, delimited_field("line", i - 1)).otherwise(delimited_field("line", i))
    return events.select(
        F.struct("source_file", "pos").alias("at"),
        "kind",
        delimited_field("line", 4).alias("cuid"),
        F.when(~short, delimited_field("line", 5)).alias("id"),
        field(6).alias("name"),
        field(7).alias("si_kind"),
    )


def import_errors(lines: DataFrame) -> DataFrame:
    """(target_id, message): the line after an "Import Error" names the id; the last message wins."""
    message = F.when(F.col("line").contains(IMPORT_ERROR), last_field("line"))
    named = previous(lines, message, "message").filter(F.col("message").isNotNull())
    return (
        named.select(last_field("line").alias("target_id"), "message", F.struct("source_file", "pos").alias("at"))
        .groupBy("target_id")
        .agg(F.max_by("message", "at").alias("message"))
    )


def entity_states(events: DataFrame) -> DataFrame:
    """State per ``cuid`` after all events.

    Exported sets everything anew, Removing marks as deleted, Imported sets the
    target only; without an Exported, name and kind come from the first event.
    That fold equals "the last of each kind, and which came later", so it is a
    plain aggregation that combines before the shuffle.
    """
    kind, at = F.col("kind"), F.col("at")

    def last_of(name: str, value: Column) -> Column:
        return F.max_by(value, F.when(kind == name, at))

    def last_at(name: str) -> Column:
        return F.max(F.when(kind == name, at))

    folded = events.groupBy("cuid").agg(
        last_at("Exported").alias("exported_at"),
        last_at("Removing").alias("removed_at"),
        last_at("Imported").alias("imported_at"),
        last_of("Exported", F.struct("id", "name", "si_kind")).alias("export"),
        last_of("Imported", F.col("id")).alias("import_id"),
        F.min_by(F.struct("name", "si_kind"), "at").alias("first"),
    )
    exported = F.col("exported_at").isNotNull()
    after = lambda c: F.col(c).isNotNull() & (~exported | (F.col(c) > F.col("exported_at")))
    text = lambda c: F.coalesce(c, F.lit(""))
    return folded.select(
        "cuid",
        text(F.when(exported, F.col("export.name")).otherwise(F.col("first.name"))).alias("name"),
        text(F.col("export.id")).alias("source_id"),
        text(F.when(after("imported_at"), F.col("import_id"))).alias("target_id"),
        text(F.when(exported, F.col("export.si_kind")).otherwise(F.col("first.si_kind"))).alias("si_kind"),
        after("removed_at").alias("deleted"),
    )


def with_errors(states: DataFrame, errors: DataFrame) -> DataFrame:
    """States with the error of their target id, if any.

    States without a target share the empty id. They are salted, and the one
    error the empty id may have is repeated per salt, so they do not all meet in
    one task.
    """
    empty = F.col("target_id") == ""
    salt = F.when(empty, F.pmod(F.hash("cuid"), F.lit(EMPTY_ID_SALTS))).otherwise(F.lit(0))
    salts = F.when(empty, F.sequence(F.lit(0), F.lit(EMPTY_ID_SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = errors.select("target_id", "message", F.explode(salts).alias("_salt"))
    joined = states.withColumn("_salt", salt).join(salted, ["target_id", "_salt"], "left")
    return joined.select(
        *states.columns,
        F.col("message").isNotNull().alias("error"),
        F.coalesce("message", F.lit("Null")).alias("error_message"),
    )


def replication_state(lines: DataFrame) -> DataFrame:
    """(cuid, name, source_id, target_id, si_kind, deleted, error, error_message) of a log."""
    return with_errors(entity_states(replication_events(lines)), import_errors(lines))
