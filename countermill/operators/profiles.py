"""Profiles of file corpora: counter coverage and element paths."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.functions.text import rdn_class

# Task code travels with its task, so workers need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

PATH_PARTIALS = "path STRING, attribute STRING, occurrences BIGINT, with_text BIGINT"


def coverage(pairs: DataFrame, measurement: str = "measurement", counter: str = "counter_name") -> DataFrame:
    """Distinct counters per object class: (measurement, counter_count, counters in order).

    Pairs are made distinct before the shuffle; a class has at most the counters
    its model defines, so its list is bounded by the model.
    """
    distinct = pairs.filter(F.col(counter).isNotNull()).select(measurement, counter).distinct()
    counters = F.array_sort(F.collect_list(counter))
    return distinct.groupBy(measurement).agg(
        F.count(F.lit(1)).alias("counter_count"), counters.alias("counters")
    )


def counter_coverage(records: DataFrame) -> DataFrame:
    """Coverage of ``mdc`` records: every counter of an info block counts for every class in it."""
    info = records.select(F.explode("md").alias("element")).select(F.inline("element.mi"))
    classes = F.array_distinct(F.transform("mv", lambda v: rdn_class(v["moid"])))
    pairs = info.select("mt", F.explode(classes).alias("measurement"))
    return coverage(pairs.select("measurement", F.explode("mt").alias("counter_name")))


def _local(name: str) -> str:
    """Tag without its namespace."""
    return name.rpartition("}")[2]


def _profile(document: str, found: dict[str | None, list]) -> None:
    """Add a document's paths to ``found``: [occurrences, with text, attribute names].

    A document that breaks off counts once under None and adds nothing else.
    """
    mine: dict[str | None, list] = {}
    open_tags: list[str] = []

    def start(tag: str, attributes: dict[str, str]) -> None:
        open_tags.append(_local(tag))
        path = ".".join(open_tags)
        entry = mine.setdefault(path, [0, 0, set()])
        entry[0] += 1
        entry[2].update(f"{{{name}" if "}" in name else name for name in attributes)
        text_of.append(entry)

    def text(_: str) -> None:
        # Only text before the first child counts; it is noted once per element.
        if text_of[-1] is not None:
            text_of[-1][1] += 1
            text_of[-1] = None

    def end(_: str) -> None:
        open_tags.pop()
        text_of.pop()
        if text_of:
            text_of[-1] = None

    text_of: list[list | None] = []
    parser = expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    try:
        parser.Parse(document, True)
    except expat.ExpatError:
        mine = {None: [1, 0, set()]}
    for path, (occurrences, with_text, attributes) in mine.items():
        entry = found.setdefault(path, [0, 0, set()])
        entry[0] += occurrences
        entry[1] += with_text
        entry[2] |= attributes


def xml_path_profile(documents: DataFrame, text: str = "value") -> DataFrame:
    """(path, occurrence, contains_text, attributes) over a corpus of documents.

    ``occurrence`` is Multiple when the path occurs more than once anywhere. A
    document that cannot be read counts under the NULL path. Nesting needs a
    stack, which no built-in function offers, so each document is profiled by
    itself inside a task; Spark adds the partial profiles up.
    """

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str | None, list] = {}
            for document in batch[text].dropna():
                _profile(document, found)
            rows = [(path, None, n, with_text) for path, (n, with_text, _) in found.items()]
            rows += [(path, name, 0, 0) for path, (_, _, names) in found.items() for name in names]
            yield pd.DataFrame(rows, columns=["path", "attribute", "occurrences", "with_text"])

    partials = documents.select(text).mapInPandas(profile, PATH_PARTIALS)
    # Summed per path and attribute first, so a path collects each name once.
    sums = [F.sum(c).alias(c) for c in ("occurrences", "with_text")]
    profiles = (
        partials.groupBy("path", "attribute")
        .agg(*sums)
        .groupBy("path")
        .agg(*sums, F.array_sort(F.collect_list("attribute")).alias("attributes"))
    )
    return profiles.select(
        "path",
        F.when(F.col("occurrences") > 1, F.lit("Multiple")).otherwise(F.lit("Single")).alias("occurrence"),
        (F.col("with_text") > 0).alias("contains_text"),
        "attributes",
    )
