"""Silver dimensions: target columns, sources and history rules, built with scd1 / scd2."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloom.operators import quality as Q
from payloom.operators.keys import latest
from payloom.operators.scd import carry_forward, fallback, known_steps, scd1, scd2

AUDIT_DDL = "_source_table string, _loaded_at timestamp, _updated_at timestamp"
# Load time of the source row that a type 1 row shows: what later loads are compared with.
ORDER_DDL = "_source_at timestamp"
VERSION_DDL = "valid_from timestamp, valid_to timestamp, is_current boolean"


@dataclass(frozen=True)
class Dimension:
    name: str
    # Attribute columns and types, without version and audit columns.
    ddl: str
    keys: tuple[str, ...]
    # Flat tables it is made of, by suffix; the first one is the primary.
    sources: tuple[str, ...]
    # Target column -> source columns, of which the first that exists is taken.
    columns: Mapping[str, tuple[str, ...]]
    derive: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    # SCD2: columns whose change starts a new version, and the surrogate key.
    tracked: tuple[str, ...] = ()
    sk: str | None = None
    # How further sources join in: "left" on the key, "timeline" (changes of all
    # sources in order of time, each with the last known values), "fallback" or "union".
    combine: str = "left"
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        parts = [f"{self.sk} string"] if self.sk else []
        parts += [self.ddl, *([VERSION_DDL] if self.tracked else []), AUDIT_DDL, *([] if self.tracked else [ORDER_DDL])]
        return T.StructType.fromDDL(", ".join(parts))


def _round_number() -> Column:
    return F.regexp_extract("round_name", "([0-9]+)", 1).try_cast("int")


def _round_type() -> Column:
    return F.coalesce("round_type", F.when(F.col("round_name").rlike("^Round [0-9]+$"), "Regular").otherwise("Finals"))


def _display_name() -> Column:
    return F.coalesce("display_name", F.nullif(F.concat_ws(" ", "first_name", "last_name"), F.lit("")))


# The dimension tables and where their columns come from.
DIMENSIONS = {d.name: d for d in (
    Dimension("dim_competition", "competition_id string, competition_name string, short_name string, sport string",
              ("competition_id",), ("entities_competition",),
              {"competition_id": ("id", "competition_id"), "competition_name": ("name", "competition_name"),
               "short_name": ("short_name", "abbreviation")},
              derive={"sport": lambda: F.lit("Rugby League")}),
    Dimension("dim_season", "season_id string, competition_id string, season_name string, season_year int, "
              "active boolean, current_season boolean",
              ("season_id",), ("entities_season", "season_list_season"),
              {"season_id": ("id", "season_id"), "competition_id": ("competition_id",), "season_name": ("name",),
               "active": ("active",), "current_season": ("current_season",)},
              derive={"season_year": lambda: F.col("season_id").try_cast("int")},
              references={"competition_id": ("dim_competition", "competition_id")}),
    Dimension("dim_round", "round_id string, season_id string, competition_id string, round_name string, "
              "round_abbreviation string, round_number int, round_type string, is_finals boolean",
              ("round_id",), ("season_list_round",),
              {"round_id": ("id", "round_id"), "season_id": ("season_id",), "competition_id": ("competition_id",),
               "round_name": ("name", "roundName", "round_name"), "round_type": ("type", "roundType", "round_type"),
               "round_abbreviation": ("abbreviation", "roundAbbreviation", "round_abbreviation")},
              derive={"round_number": _round_number, "round_type": _round_type,
                      "is_finals": lambda: _round_type() != "Regular"},
              references={"season_id": ("dim_season", "season_id")}),
    Dimension("dim_venue", "venue_id string, venue_name string, city string, state string, country string, "
              "capacity int, surface_type string",
              ("venue_id",), ("entities_venue",),
              {"venue_id": ("id", "venue_id"), "venue_name": ("name", "venue_name"), "city": ("city",),
               "state": ("state",), "country": ("country",), "capacity": ("capacity",),
               "surface_type": ("surface_type", "surface")}),
    Dimension("dim_position", "position_id string, position_name string, position_abbreviation string, "
              "position_group string, jersey_number int",
              ("position_id",), ("entities_position",),
              {"position_id": ("id", "position_id"), "position_name": ("name", "position_name"),
               "position_abbreviation": ("abbreviation", "position_abbreviation"),
               "position_group": ("position_group", "group"), "jersey_number": ("jersey_number",)}),
    Dimension("dim_scoring_method", "method_id string, method_name string, points int",
              ("method_id",), ("entities_scoring_method",),
              {"method_id": ("id", "method_id"), "method_name": ("name", "method_name"), "points": ("points",)}),
    Dimension("dim_team", "team_id string, competition_id string, season_id string, team_name string, "
              "team_nickname string, team_abbreviation string, team_colour_primary string, team_colour_secondary string",
              ("team_id",), ("entities_team", "season_list_club"),
              {"team_id": ("id", "team_id", "teamId"), "competition_id": ("competition_id",), "season_id": ("season_id",),
               "team_name": ("name", "team_name"), "team_nickname": ("nickname", "team_nickname", "teamNickName"),
               "team_abbreviation": ("abbreviation", "team_abbreviation"),
               "team_colour_primary": ("colour_primary", "team_hex_colour", "teamHexColour"),
               "team_colour_secondary": ("colour_secondary", "team_hex_colour2", "teamHexColour2")},
              tracked=("team_name", "team_nickname", "team_abbreviation"), sk="team_sk", combine="timeline",
              references={"competition_id": ("dim_competition", "competition_id")}),
    Dimension("dim_player", "player_id string, first_name string, last_name string, display_name string, "
              "date_of_birth date, height_cm int, weight_kg int, nationality string, country_of_birth string, "
              "position_id string, career_debut_year int, career_appearances int",
              ("player_id",), ("player_profiles_player", "entities_player"),
              {"player_id": ("player_id", "id"), "first_name": ("player_first_name", "first_name"),
               "last_name": ("player_last_name", "last_name"), "display_name": ("player_name", "display_name"),
               "date_of_birth": ("date_of_birth", "dob"), "height_cm": ("height_cm", "height"),
               "weight_kg": ("weight_kg", "weight"), "nationality": ("nationality",),
               "country_of_birth": ("country_of_birth",), "position_id": ("position_id",),
               "career_debut_year": ("career_debut_year",), "career_appearances": ("career_appearances",)},
              derive={"display_name": _display_name},
              tracked=("position_id", "weight_kg", "height_cm"), sk="player_sk", combine="fallback",
              references={"position_id": ("dim_position", "position_id")}),
    Dimension("dim_coach", "coach_id string, season_id string, team_id string, first_name string, last_name string, "
              "display_name string, coaching_role string",
              ("coach_id",), ("season_list_coach", "all_squads_coach"),
              {"coach_id": ("coach_id", "coachId", "id"), "season_id": ("season_id",), "team_id": ("team_id", "teamId"),
               "first_name": ("first_name", "firstName"), "last_name": ("last_name", "lastName"),
               "display_name": ("display_name", "name", "full_name"),
               "coaching_role": ("coaching_role", "role_name", "roleName", "role")},
              derive={"display_name": _display_name},
              tracked=("team_id", "coaching_role"), sk="coach_sk", combine="union",
              references={"season_id": ("dim_season", "season_id")}),
    Dimension("dim_official", "official_id string, season_id string, first_name string, last_name string, "
              "display_name string, role string",
              ("official_id", "season_id"), ("season_list_official",),
              {"official_id": ("official_id", "officialId", "id"), "season_id": ("season_id",),
               "first_name": ("first_name", "firstName"), "last_name": ("last_name", "lastName"),
               "display_name": ("display_name", "name"), "role": ("role",)},
              derive={"display_name": _display_name},
              references={"season_id": ("dim_season", "season_id")}),
)}


def _shape(dim: Dimension, df: DataFrame, source: str) -> DataFrame:
    """Source rows under the target's column names and types; absent columns are NULL."""
    types = {f.name: f.dataType for f in T.StructType.fromDDL(dim.ddl).fields}
    have = {c.lower(): c for c in df.columns}

    def pick(target: str) -> Column:
        found = next((have[c.lower()] for c in dim.columns.get(target, ()) if c.lower() in have), None)
        value = F.lit(None) if found is None else F.col(f"`{found}`")
        return (value.cast("string").try_cast(types[target]) if found is not None else value.cast(types[target])).alias(target)

    rows = df.select(*[pick(c) for c in types], F.col("ingested_at").cast("timestamp").alias("ingested_at"),
                     F.lit(source).alias("_source_table"))
    return rows.withColumns({c: make().cast(types[c]) for c, make in dim.derive.items()}) if dim.derive else rows


def _combined(dim: Dimension, tables: Mapping[str, DataFrame], existing: DataFrame | None = None,
              only: DataFrame | None = None) -> DataFrame:
    shaped = [_shape(dim, tables[s], s) for s in dim.sources if s in tables]
    if not shaped:
        raise ValueError(f"{dim.name} needs one of {dim.sources}")
    if only is not None:
        shaped = [df.join(only, list(dim.keys), "left_semi") for df in shaped]
    rows = shaped[0]
    for other in shaped[1:]:
        if dim.combine in ("union", "timeline"):
            rows = rows.unionByName(other)
        elif dim.combine == "fallback":
            if existing is not None:
                # Keys that the primary source has brought before need no fallback.
                known = existing.filter(F.col("_source_table") == dim.sources[0]).select(*dim.keys).distinct()
                other = other.join(known, list(dim.keys), "left_anti")
            rows = fallback(rows, other, dim.keys)
        else:
            # Attributes the primary lacks come from the newest row of the other source.
            extra = latest(other, dim.keys, ("ingested_at",), ())
            names = [c for c in T.StructType.fromDDL(dim.ddl).names if c not in dim.keys]
            extra = extra.select(*dim.keys, *[F.col(c).alias(f"__{c}") for c in names])
            rows = rows.join(extra, list(dim.keys), "left").withColumns(
                {c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in names}).drop(*[f"__{c}" for c in names])
    return rows.filter(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in dim.keys)))


def skipped_rows(dim: Dimension, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(source, n_rows, n_without_key, n_without_time) of the rows a dimension is built from; those without either are not in it."""
    counts = []
    for source in dim.sources:
        if source in tables:
            rows = _shape(dim, tables[source], source)
            no_key = F.expr(" OR ".join(f"{k} IS NULL" for k in dim.keys))
            counts.append(rows.agg(F.count("*").alias("n_rows"), F.count_if(no_key).alias("n_without_key"),
                                   F.count_if(F.col("ingested_at").isNull()).alias("n_without_time"))
                          .select(F.lit(source).alias("source"), "*"))
    return Q.union_results(counts)


def _timeline(dim: Dimension, rows: DataFrame) -> DataFrame:
    """Per key and time at which anything changes, the last known value of each column, whichever source it came from.

    At equal times the earlier source in ``dim.sources`` counts first.
    """
    names = [c for c in rows.columns if c not in (*dim.keys, "ingested_at") and not c.startswith("_")]
    rank = F.array_position(F.array(*map(F.lit, dim.sources)), F.col("_source_table"))
    return known_steps(rows, dim.keys, names, "ingested_at", [rank.desc()])


def _versions(dim: Dimension, rows: DataFrame, now: Column, existing: DataFrame | None) -> DataFrame:
    """Type 2 rows out of source rows and, if given, the versions that were stored before.

    A stored version is the change that opened it. Its load time stays; its
    update time moves when a new version closes it. New rows have to be later
    than the stored ones of their key, as those of the next window are.
    """
    carry = [c for c in T.StructType.fromDDL(dim.ddl).names if c not in (*dim.keys, *dim.tracked)]
    stamps = ("_source_table", "_loaded_at", "_updated_at", "__open")
    rows = rows.withColumns({"_loaded_at": now, "_updated_at": now, "__open": F.lit(None).cast("boolean")})
    if existing is not None:
        stored = existing.withColumn("ingested_at", F.col("valid_from")).withColumn("__open", F.col("valid_to").isNull())
        rows = rows.unionByName(stored.select(*rows.columns))
    if dim.combine == "timeline":
        known = [c for c in T.StructType.fromDDL(dim.ddl).names if c not in dim.keys]
        rows = carry_forward(rows, dim.keys, known, "ingested_at") if existing is not None else rows
    out = scd2(rows, dim.keys, dim.tracked, "ingested_at", chunk="year", sk=dim.sk, carry=(*carry, *stamps))
    closed = F.col("__open") & F.col("valid_to").isNotNull()
    return out.withColumn("_updated_at", F.when(closed, now).otherwise(F.col("_updated_at")))


def _rebuilt(dim: Dimension, tables: Mapping[str, DataFrame], history: Mapping[str, DataFrame], now: Column,
             existing: DataFrame) -> DataFrame:
    """Versions of the keys in ``tables`` built again from all of their rows; versions of other keys as stored.

    A version that is the same as before keeps both of its load times, one
    that has another end or other values gets a new update time.
    """
    keys = list(dim.keys)
    loaded = [_shape(dim, tables[s], s) for s in dim.sources if s in tables]
    touched = Q.union_results([df.filter(F.col("ingested_at").isNotNull()).select(*keys) for df in loaded]).distinct()
    rows = _combined(dim, history, only=touched).filter(F.col("ingested_at").isNotNull())
    rows = _timeline(dim, rows) if dim.combine == "timeline" else rows
    fresh = _versions(dim, rows, now, None).select(*dim.schema.names)
    same = [c for c in dim.schema.names if c not in ("_loaded_at", "_updated_at", dim.sk)]
    stored = existing.select(dim.sk, "_loaded_at", "_updated_at", F.struct(*same).alias("__stored"))
    stored = stored.withColumnsRenamed({"_loaded_at": "__loaded", "_updated_at": "__updated"})
    unchanged = F.struct(*same).eqNullSafe(F.col("__stored"))
    fresh = fresh.join(stored, dim.sk, "left").withColumns({
        "_loaded_at": F.coalesce("__loaded", "_loaded_at"),
        "_updated_at": F.when(unchanged, F.col("__updated")).otherwise(F.col("_updated_at"))})
    return existing.join(touched, keys, "left_anti").select(*dim.schema.names).unionByName(fresh.select(*dim.schema.names))


def build_dimension(dim: Dimension, tables: Mapping[str, DataFrame], loaded_at: Column | None = None,
                    existing: DataFrame | None = None, history: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All rows of a dimension from its flat tables and what is stored of it, in the target's column order.

    Write the result next to the old table and swap: it reads ``existing``.
    Rows without key or time are left out; ``skipped_rows`` counts them.
    Type 2 rows in ``tables`` have to be later than the stored ones of their
    key, unless ``history`` has the flat tables of all loads, this one's among
    them: then the keys of this load are built again from all of their rows,
    and loads may come in any order. Type 1 rows need no history.
    """
    now = loaded_at if loaded_at is not None else F.current_timestamp()
    if history is not None and existing is not None and dim.tracked:
        return _rebuilt(dim, tables, history, now, existing)
    rows = _combined(dim, tables, existing)
    if dim.tracked:
        rows = _timeline(dim, rows.filter(F.col("ingested_at").isNotNull())) if dim.combine == "timeline" else rows
        return _versions(dim, rows, now, existing).select(*dim.schema.names)
    rows = rows.withColumnRenamed("ingested_at", "_source_at").withColumns({"_loaded_at": now, "_updated_at": now})
    if existing is None:
        return latest(rows, dim.keys, ("_source_at",), ("_source_table",)).select(*dim.schema.names)
    return scd1(rows.select(*dim.schema.names), dim.keys, ("_source_at",), existing=existing).select(*dim.schema.names)


def dimension_checks(dim: Dimension, built: Mapping[str, DataFrame]) -> DataFrame:
    """Informational keys as checks: unique and non-null key, references that resolve."""
    df = built[dim.name]
    key = (dim.sk,) if dim.sk else dim.keys
    results = [Q.expect_unique(df, key, f"{dim.name}:unique"), Q.expect_not_null(df, key, dim.name)]
    for column, (target, target_column) in dim.references.items():
        if target in built:
            rows = df.filter(F.col(column).isNotNull())
            # A reference within the key has the name of its not-null check otherwise.
            name = f"{dim.name}:{column}:{target}" if column in key else f"{dim.name}:{column}"
            results.append(Q.expect_parent(rows, built[target], {column: target_column}, name))
    return Q.union_results(results)


def create_dimension_tables(spark: SparkSession, database: str) -> None:
    """All dimension tables, empty, in one database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for dim in DIMENSIONS.values():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dim.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{dim.name} ({columns}) USING parquet")
