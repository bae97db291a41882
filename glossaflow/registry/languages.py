"""Language registries as small DataFrames.

Every registry has at most a few hundred rows, fixed at build time: these are the only tables the engine
broadcasts by hint. Lists of target codes are Python lists for the same reason.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.registry import fixed_values

FLORES = "flores"
CLOUD = "cloud"
CLOUD_BACKEND = "google_cloud_translate"


def _rows(text: str) -> list[tuple[str, str]]:
    return [tuple(line.split("  ", 1)) for line in text.strip().splitlines()]


FLORES_LANGUAGES = _rows(fixed_values.FLORES)
CLOUD_LANGUAGES = _rows(fixed_values.CLOUD)
MT5_LANGUAGES = _rows(fixed_values.MT5)


def system_of(backend_name: str) -> str:
    """The registry a backend takes its codes from."""
    return CLOUD if backend_name == CLOUD_BACKEND else FLORES


def small_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A DataFrame over values already held in Python; Arrow input keeps it a local relation with known size."""
    return spark.createDataFrame(pa.table(columns))


def languages(spark: SparkSession, system: str | None = None) -> DataFrame:
    """``(system, code, name, ordinal)`` of one registry or of both."""
    entries = [
        (name_of_system, code, name, i)
        for name_of_system, table in ((FLORES, FLORES_LANGUAGES), (CLOUD, CLOUD_LANGUAGES))
        for i, (code, name) in enumerate(table)
        if system in (None, name_of_system)
    ]
    return small_table(
        spark, {c: list(v) for c, v in zip(("system", "code", "name", "ordinal"), zip(*entries))}
    )


def mt5_languages(spark: SparkSession) -> DataFrame:
    """``(code, name, ordinal)`` of the mT5 languages."""
    codes, names = zip(*MT5_LANGUAGES)
    return small_table(spark, {"code": list(codes), "name": list(names), "ordinal": list(range(len(codes)))})


def canonical_codes(registry: DataFrame) -> DataFrame:
    """One ``(system, name, code)`` per name: of several codes for a name the one declared last."""
    return registry.groupBy("system", "name").agg(F.max_by("code", "ordinal").alias("code"))


def canonical_languages(spark: SparkSession, system: str) -> DataFrame:
    """:func:`canonical_codes` of a packaged registry, without a job."""
    table = {name: code for code, name in (FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES)}
    return small_table(spark, {"name": list(table), "code": list(table.values())})


def names_to_codes(df: DataFrame, name_column: str, canonical: DataFrame, out: str) -> DataFrame:
    """Add the code of the language named in ``name_column``; null when it is not in ``canonical``."""
    lookup = canonical.select(F.col("name").alias(name_column), F.col("code").alias(out))
    return df.join(F.broadcast(lookup), name_column, "left")


def unknown_names(df: DataFrame, name_column: str, canonical: DataFrame) -> DataFrame:
    """The distinct names in ``name_column`` that ``canonical`` does not hold, to be reported before a job starts."""
    known = canonical.select(F.col("name").alias(name_column))
    return df.select(name_column).distinct().join(F.broadcast(known), name_column, "left_anti")


def codes_to_names(df: DataFrame, code_column: str, registry: DataFrame, out: str) -> DataFrame:
    """Add the name of the language coded in ``code_column``; null when the registry does not know it."""
    lookup = registry.select(F.col("code").alias(code_column), F.col("name").alias(out))
    return df.join(F.broadcast(lookup), code_column, "left")


def normalise_codes(df: DataFrame, code_column: str, registry: DataFrame, out: str) -> DataFrame:
    """Code to name and back, which replaces alias codes (``zh``, ``iw``, ``jw``) by the canonical one."""
    named = codes_to_names(df, code_column, registry, "__name")
    return names_to_codes(named, "__name", canonical_codes(registry), out).drop("__name")


def mt5_matches(spark: SparkSession, whole_word: bool = False) -> DataFrame:
    """Every Flores language whose name contains the name of an mT5 language.

    The substring test is an equi-join: each Flores name is expanded to its substrings, which are then
    matched by hash, so no pairing of all rows takes place. ``whole_word`` keeps matches that start and
    end at a word boundary ("Malay" no longer finds "Malayalam").
    """
    mt5 = mt5_languages(spark).select(
        F.col("code").alias("mt5_code"), F.col("name").alias("mt5_name"), F.col("ordinal").alias("mt5_ordinal")
    )
    flores = languages(spark, FLORES).select(
        F.col("code").alias("flores_code"), F.col("name").alias("flores_name"), F.col("ordinal").alias("flores_ordinal")
    )
    size = F.length("flores_name")
    pieces = (
        flores.withColumn("start", F.explode(F.sequence(F.lit(1), size)))
        .withColumn("len", F.explode(F.sequence(F.lit(1), size - F.col("start") + 1)))
        .withColumn("mt5_name", F.expr("substring(flores_name, start, len)"))
    )
    if whole_word:
        before = F.expr("substring(concat(' ', flores_name), start, 1)")
        after = F.expr("substring(concat(flores_name, ' '), start + len, 1)")
        pieces = pieces.where(before.rlike(r"^\W") & after.rlike(r"^\W"))
    pieces = pieces.drop("start", "len").distinct()
    return mt5.join(pieces, "mt5_name").select(
        "mt5_code", "mt5_name", "mt5_ordinal", "flores_code", "flores_name", "flores_ordinal"
    )


def mt5_mapping(spark: SparkSession, whole_word: bool = False) -> DataFrame:
    """``(code, name, matches)``: the matches of each mT5 language that has any, in declaration order."""
    match = F.struct("flores_ordinal", F.col("flores_code").alias("code"), F.col("flores_name").alias("name"))
    ordered = F.sort_array(F.collect_list(match))
    return (
        mt5_matches(spark, whole_word)
        .groupBy(F.col("mt5_code").alias("code"), F.col("mt5_name").alias("name"))
        .agg(F.transform(ordered, lambda m: F.struct(m["code"].alias("code"), m["name"].alias("name"))).alias("matches"))
    )


def mt5_unmapped(spark: SparkSession, whole_word: bool = False) -> DataFrame:
    """mT5 languages no Flores name contains."""
    mapped = mt5_matches(spark, whole_word).select(F.col("mt5_code").alias("code"))
    return mt5_languages(spark).join(mapped, "code", "left_anti")


def mapping_json(mapping: DataFrame) -> DataFrame:
    """The whole mapping as one JSON object ``{"code": [["flores code", "flores name"], ...], ...}``.

    One row, bounded by the size of the two registries; write it with ``.write.text``.
    """
    pairs = F.transform("matches", lambda m: F.array(m["code"], m["name"]))
    entries = F.sort_array(F.collect_list(F.struct("code", pairs.alias("pairs"))))
    return mapping.agg(F.to_json(F.map_from_entries(entries), {"pretty": "true"}).alias("json"))


def iso_audit(named: DataFrame, iso: DataFrame) -> DataFrame:
    """Check ``(name, code)`` rows against an ISO-639 table ``(name, part1, part2b, part2t, part3, part5)``.

    Adds ``status``: ``ok``, ``missing`` (name unknown) or ``mismatch`` (no part equals the code).
    """
    parts = ("part1", "part3", "part5", "part2t", "part2b")
    # A name may have several rows: it is right if any part of any of them equals the code.
    table = iso.groupBy("name").agg(F.flatten(F.collect_set(F.array(*parts))).alias("__codes"))
    equal = F.coalesce(F.array_contains("__codes", F.col("code")), F.lit(False))
    return (
        named.join(table, "name", "left")
        .withColumn("status", F.when(F.col("__codes").isNull(), "missing").when(equal, "ok").otherwise("mismatch"))
        .drop("__codes")
    )


def default_targets(spark: SparkSession, system: str) -> DataFrame:
    """``(code, name, ordinal)`` of the languages mT5 covers, derived from the registries.

    Flores: every language the mT5 mapping reaches. Cloud: every code whose primary subtag is an mT5 code,
    aliases folded into the canonical code.
    """
    registry = languages(spark, system)
    if system == FLORES:
        codes = mt5_matches(spark).select(F.col("flores_code").alias("code"), F.col("mt5_ordinal").alias("ordinal"))
    else:
        mt5 = mt5_languages(spark).select(F.col("code").alias("primary"), "ordinal")
        primary = F.split("code", "-")[0].alias("primary")
        codes = normalise_codes(
            registry.select("code", primary).join(F.broadcast(mt5), "primary"), "code", registry, "canonical"
        ).select(F.col("canonical").alias("code"), "ordinal")
    first = codes.groupBy("code").agg(F.min("ordinal").alias("ordinal"))
    return codes_to_names(first, "code", registry, "name").select("code", "name", "ordinal")


def target_languages(
    spark: SparkSession,
    system: str,
    codes: Sequence[str] | None = None,
    exclude_names: Iterable[str] = ("English",),
) -> DataFrame:
    """``(code, name, ordinal)`` of the languages to translate into.

    Unknown codes are refused before anything is excluded; duplicates keep their first place; alias codes
    become the canonical code.
    """
    if codes is None:
        targets = default_targets(spark, system)
    else:
        check_codes(codes, system)
        registry = languages(spark, system)
        wanted = small_table(spark, {"asked": list(codes), "place": list(range(len(codes)))})
        targets = (
            codes_to_names(
                normalise_codes(wanted, "asked", registry, "code"), "code", registry, "name"
            )
            .groupBy("code", "name")
            .agg(F.min("place").alias("ordinal"))
        )
    return targets.where(~F.col("name").isin(list(exclude_names)))


def target_codes(
    system: str, codes: Sequence[str] | None = None, exclude_names: Iterable[str] = ("English",)
) -> list[str]:
    """The codes of :func:`target_languages` in order, worked out from the packaged lists without a job."""
    table = FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES
    names = dict(table)
    canonical = {name: code for code, name in table}
    if codes is not None:
        check_codes(codes, system)
    elif system == FLORES:
        codes = [code for _, mt5_name in MT5_LANGUAGES for code, name in table if mt5_name in name]
    else:
        codes = [code for mt5_code, _ in MT5_LANGUAGES for code, _ in table if code.split("-")[0] == mt5_code]
    wanted = dict.fromkeys(canonical[names[code]] for code in codes)
    return [code for code in wanted if names[code] not in set(exclude_names)]


def literal_list(values: Sequence) -> Column:
    """A constant array column of strings, or of arrays of strings, as one expression whatever its length."""
    element = "array<string>" if values and not isinstance(values[0], str) else "string"
    return F.from_json(F.lit(json.dumps(values)), f"array<{element}>")


def check_codes(codes: Sequence[str], system: str) -> None:
    """Raise ``ValueError`` naming every code the registry does not hold."""
    known = {code for code, _ in (FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES)}
    unknown = [code for code in codes if code not in known]
    if unknown:
        raise ValueError(f"unknown {system} language codes: {', '.join(unknown)}")


def code_of(name: str, system: str = FLORES) -> str:
    """Code of one language name; of several codes the one declared last."""
    table = dict((n, c) for c, n in (FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES))
    if name not in table:
        raise ValueError(f"unknown {system} language name: {name}")
    return table[name]


def codes_of(names: Iterable[str], system: str = FLORES) -> list[str]:
    """Codes of language names, in order; all unknown names are reported together."""
    table = {n: c for c, n in (FLORES_LANGUAGES if system == FLORES else CLOUD_LANGUAGES)}
    names = list(names)
    unknown = [name for name in names if name not in table]
    if unknown:
        raise ValueError(f"unknown {system} language names: {', '.join(unknown)}")
    return [table[name] for name in names]


def resolve_sources(df: DataFrame, name_column: str, system: str = FLORES, shown: int = 20) -> DataFrame:
    """``df`` with the code of the language named in ``name_column`` as ``source``; null stays null.

    Names the registry does not hold are found before anything else runs, and raise ``ValueError``.
    """
    canonical = canonical_languages(df.sparkSession, system)
    named = df.where(F.col(name_column).isNotNull())
    unknown = [r[0] for r in unknown_names(named, name_column, canonical).orderBy(name_column).limit(shown).collect()]
    if unknown:
        raise ValueError(f"unknown {system} language names: {', '.join(unknown)}")
    return names_to_codes(df, name_column, canonical, "source")


def registry_checks(registry: DataFrame) -> DataFrame:
    """Rows, distinct codes and distinct names of each registry."""
    return registry.groupBy("system").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("code").alias("n_codes"),
        F.count_distinct("name").alias("n_names"),
    )
