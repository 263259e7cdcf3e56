"""The tables of the warehouse, how each is refreshed, its schema tests, and the hourly run."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import contract, dims, keymarks
from tidemark.operators import incremental as inc
from tidemark.operators.checks import TableTests, run_tests
from tidemark.operators.incremental import Restriction, Table
from tidemark.operators.late import Ledger, reconcile
from tidemark.operators.ranges import spans_to_read, touched_rows
from tidemark.operators.staging import build_staging
from tidemark.plans import models as m
from tidemark.session import use_utc
from tidemark.sources import config as cfg
from tidemark.sources import landing, paths
from tidemark.sources.feeds import FEEDS
from tidemark.sources.mappings import FIELD_MAPPINGS

HOURS_6, HOURS_12, DAYS_2 = timedelta(hours=6), timedelta(hours=12), timedelta(days=2)

# Fixed value: first day of the calendar; it runs one year past the run.
CALENDAR_START = date(2026, 1, 1)
CALENDAR_AHEAD = timedelta(days=365)


def _with_alert_date(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def built(**sources: DataFrame) -> DataFrame:
        return build(**sources).withColumn("date_utc", F.to_date("observed_at"))

    return built


def _with_target_date(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def built(**sources: DataFrame) -> DataFrame:
        return build(**sources).withColumn("forecast_date_utc", F.to_date("forecast_at"))

    return built


@dataclass(frozen=True)
class Model:
    """An incremental model: target table, builder, inputs and how the lookback restricts them.

    ``inputs`` maps the builder's argument to a stored table or, with a ``staging:`` prefix, to a
    feed whose landing rows are restricted before they are staged.
    """

    table: Table
    build: Callable[..., DataFrame]
    inputs: dict[str, str]
    restrictions: dict[str, Restriction]
    needs_as_of: bool = False


def _hourly(name: str, feed: str, build, ranking) -> Model:
    return Model(
        Table(name, "intermediate", "city_hour_key", "date_utc", "extracted_at", HOURS_6, aligned=False, ranking=ranking),
        build,
        {"staged": f"staging:{feed}"},
        {"staged": Restriction("extracted_at", landing.PARTITION)},
    )


def _hourly_fact(name: str, source: str, build, arg: str = "hourly") -> Model:
    return Model(
        Table(name, "marts", "city_hour_key", "date_utc", "observed_at", HOURS_12),
        build,
        {arg: source},
        {arg: Restriction("observed_at", "date_utc")},
    )


def _daily_fact(name: str, build, inputs: dict[str, str]) -> Model:
    return Model(
        Table(name, "marts", "city_date_key", "date_utc", "date_utc", DAYS_2, inclusive=True),
        build,
        inputs,
        {arg: Restriction("date_utc") for arg in inputs},
    )


INTERMEDIATE: tuple[Model, ...] = (
    _hourly("int_city_hourly_weather", "current_weather", m.hourly_weather, m.WEATHER_RANK),
    _hourly("int_city_hourly_pollution", "air_pollution", m.hourly_pollution, m.POLLUTION_RANK),
    _hourly("int_city_hourly_traffic_flow", "traffic_flow", m.hourly_traffic_flow, m.FLOW_RANK),
    Model(
        Table("int_city_hourly_traffic_incidents", "intermediate", "city_incident_key", "date_utc", "extracted_at",
              HOURS_6, aligned=False, ranking=m.INCIDENT_RANK),
        m.traffic_incidents,
        {"staged": "staging:traffic_incidents"},
        {"staged": Restriction("extracted_at", landing.PARTITION)},
    ),
    Model(
        Table("int_city_weather_forecast", "intermediate", "forecast_key", "forecast_date_utc", "issued_at",
              HOURS_6, aligned=False, ranking=m.ISSUANCE_RANK),
        m.forecast_history,
        {"staged": "staging:weather_forecast"},
        {"staged": Restriction("extracted_at", landing.PARTITION)},
    ),
)

FACTS: tuple[Model, ...] = (
    _daily_fact("fct_weather_daily", m.weather_daily, {"hourly": "int_city_hourly_weather"}),
    _daily_fact("fct_pollution_daily", m.pollution_daily, {"hourly": "int_city_hourly_pollution"}),
    _daily_fact(
        "fct_traffic_daily",
        m.traffic_daily,
        {"flow": "int_city_hourly_traffic_flow", "incidents": "int_city_hourly_traffic_incidents"},
    ),
    _hourly_fact("fct_weather_hourly", "int_city_hourly_weather", m.weather_hourly_fact),
    _hourly_fact("fct_pollution_hourly", "int_city_hourly_pollution", m.pollution_hourly_fact),
    _hourly_fact("fct_traffic_hourly", "int_city_hourly_traffic_flow", m.traffic_hourly_fact, "flow"),
    Model(
        Table("fct_forecast_accuracy", "marts", "forecast_key", "forecast_date_utc", "forecast_at", DAYS_2, inclusive=True),
        _with_target_date(m.forecast_accuracy),
        {"forecast": "int_city_weather_forecast", "weather": "int_city_hourly_weather"},
        # the observed hour lies on the target's day, so the same bound prunes the observations
        {"forecast": Restriction("forecast_at", "forecast_date_utc"), "weather": Restriction(None, "date_utc")},
        needs_as_of=True,
    ),
)

POLLUTION_ALERTS = Model(
    Table("mart_pollution_alerts", "marts", "alert_key", "date_utc", "observed_at", HOURS_12, replace_range=True),
    _with_alert_date(m.pollution_alerts),
    {"hourly_fact": "fct_pollution_hourly"},
    {"hourly_fact": Restriction("observed_at", "date_utc")},
)



@dataclass(frozen=True)
class Rolling:
    """A mart with row-based frames of at most ``reach`` rows over daily facts, stored by day.

    ``build`` takes the facts under the names of ``inputs``. Attributes that a city lends to all its rows come
    from ``dim_city``: where one of ``lent`` changes, the whole city is computed again.
    """

    table: Table
    build: Callable[..., DataFrame]
    inputs: dict[str, str]
    reach: int
    lent: tuple[str, ...] = ()


ROLLING: dict[str, Rolling] = {
    x.table.name: x
    for x in (
        Rolling(
            Table("mart_temperature_trends", "marts", "city_date_key", "date_utc", "date_utc", DAYS_2, inclusive=True),
            m.temperature_trends, {"weather": "fct_weather_daily"}, 30,
        ),
        Rolling(
            Table("mart_city_daily", "marts", "city_date_key", "date_utc", "date_utc", DAYS_2, inclusive=True),
            m.city_daily,
            {"weather": "fct_weather_daily", "pollution": "fct_pollution_daily", "traffic": "fct_traffic_daily"},
            14, ("country",),
        ),
    )
}

INCREMENTAL: dict[str, Model] = {x.table.name: x for x in (*INTERMEDIATE, *FACTS, POLLUTION_ALERTS)}
DIMENSIONS = ("dim_city", "dim_date", "dim_hour")
REBUILT = DIMENSIONS + ("mart_city_daily", "mart_forecast_latest", "mart_temperature_trends", "mart_weather_alerts")

BACKFILL_KEYS = {
    "int_city_hourly_weather": m.city_hour_key,
    "int_city_hourly_pollution": m.city_hour_key,
    "int_city_hourly_traffic_flow": m.city_hour_key,
    "int_city_hourly_traffic_incidents": m.incident_key,
    "int_city_weather_forecast": m.issuance_key,
}

# ---- schema tests -------------------------------------------------------------------------------

_CITY = ("city_key", "dim_city", "city_key")
_DATE = ("date_key", "dim_date", "date_key")
_HOUR = ("hour_utc", "dim_hour", "hour_utc")


def _fact_tests(key: str, *links: tuple[str, str, str]) -> TableTests:
    return TableTests(unique=(key,), not_null=(key,), relationships=links)


def _hourly_tests(key: str, *more: str) -> TableTests:
    return TableTests(unique=(key,), not_null=(key, "city", *more))


INTERMEDIATE_TESTS: dict[str, TableTests] = {
    "int_city_hourly_weather": _hourly_tests("city_hour_key", "observed_at"),
    "int_city_hourly_pollution": _hourly_tests("city_hour_key", "observed_at", "aqi"),
    "int_city_hourly_traffic_flow": _hourly_tests("city_hour_key", "observed_at"),
    "int_city_hourly_traffic_incidents": _hourly_tests("city_incident_key", "observed_at"),
    "int_city_weather_forecast": _hourly_tests("forecast_key", "forecast_at", "issued_at"),
}
MART_TESTS: dict[str, TableTests] = {
    "dim_city": TableTests(unique=("city_key",), not_null=("city_key", "city")),
    "dim_hour": TableTests(unique=("hour_utc",), not_null=("hour_utc", "hour_label", "day_part")),
    "dim_date": TableTests(unique=("date_key",), not_null=("date_key", "date_utc")),
    "fct_weather_daily": _fact_tests("city_date_key", _CITY, _DATE),
    "fct_pollution_daily": _fact_tests("city_date_key", _CITY, _DATE),
    "fct_traffic_daily": _fact_tests("city_date_key", _CITY, _DATE),
    "fct_traffic_hourly": _fact_tests("city_hour_key", _CITY, _DATE, _HOUR),
    "fct_weather_hourly": _fact_tests("city_hour_key", _CITY, _DATE, _HOUR),
    "fct_pollution_hourly": _fact_tests("city_hour_key", _CITY, _DATE, _HOUR),
    "fct_forecast_accuracy": _fact_tests("forecast_key", _CITY),
    "mart_city_daily": TableTests(
        unique=("city_date_key",),
        not_null=("city_date_key",),
        relationships=(_CITY,),
        accepted=(
            ("comfort_index_label", ("Excellent", "Good", "Fair", "Poor", "No data")),
            ("congestion_label", ("Low", "Moderate", "High", "Severe", "No data")),
            ("comfort_trend", ("Improving", "Stable", "Worsening", "Insufficient data")),
        ),
    ),
    "mart_forecast_latest": _fact_tests("forecast_slot_key", _CITY),
    "mart_temperature_trends": TableTests(
        unique=("city_date_key",),
        not_null=("city_date_key",),
        accepted=(("temp_anomaly_label", ("Hot anomaly", "Cold anomaly", "Normal")),),
    ),
    "mart_weather_alerts": TableTests(
        not_null=("alert_key", "city", "forecast_at"),
        accepted=(("alert_type", tuple(r.alert_type for r in m.WEATHER_ALERTS)),),
    ),
    "mart_pollution_alerts": TableTests(
        not_null=("alert_key", "city", "observed_at"),
        accepted=(("alert_type", tuple(r.alert_type for r in m.POLLUTION_ALERTS)),),
    ),
}


#: Fixed value: the note beside the marks of a table that changed since.
UNMARKED = "_UNMARKED"


class SchemaTestError(RuntimeError):
    """A schema test of a layer failed; later layers were not built."""


# ---- running ------------------------------------------------------------------------------------


@dataclass
class Warehouse:
    """A warehouse below one root folder. One writer per root; runs are serialised.

    With ``track_late`` every run first enters into a ledger the landed rows that its lookback leaves out.
    With ``bounded_marts`` the marts with rolling frames are stored by day, and a run computes only the rows
    that the days it changed can reach. With ``key_marks`` the uniqueness tests of a run hold the days it wrote against
    all stored days, of which it reads those that key bitmaps cannot rule out. Whoever writes the tables by other
    means removes the folder ``_marks``.
    """

    spark: SparkSession
    root: str
    mappings: dict[str, list] = field(default_factory=lambda: dict(FIELD_MAPPINGS))
    compare_existing: bool = True
    calendar_start: date = CALENDAR_START
    track_late: bool = False
    bounded_marts: bool = False
    key_marks: bool = False
    mark_slots: int = keymarks.SLOTS
    written: dict[str, list[str] | None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        use_utc(self.spark)

    def path(self, name: str) -> str:
        layer = "intermediate" if name.startswith("int_") else "marts"
        return f"{self.root}/{layer}/{name}"

    def table(self, name: str) -> DataFrame:
        """A stored table. A partitioned one without rows has no files, so it is planned as empty."""
        path = self.path(name)
        if name in INCREMENTAL and not paths.has_data(self.spark, path):
            build, sources = self._plan(name, datetime(1970, 1, 1))
            return build(**sources).limit(0)
        return inc.read_table(self.spark, path)

    def _plan(self, name: str, as_of: datetime) -> tuple[Callable[..., DataFrame], dict[str, DataFrame]]:
        """Builder and unrestricted sources of an incremental model."""
        model = INCREMENTAL[name]
        feeds = {arg: s.removeprefix("staging:") for arg, s in model.inputs.items() if s.startswith("staging:")}
        sources = {
            arg: landing.read_landing(self.spark, self.root, feeds[arg]) if arg in feeds else self.table(source)
            for arg, source in model.inputs.items()
        }

        def build(**dfs: DataFrame) -> DataFrame:
            staged = {arg: build_staging(dfs[arg], self.mappings[feed]) for arg, feed in feeds.items()}
            extra = {"as_of": as_of} if model.needs_as_of else {}
            return model.build(**{**dfs, **staged, **extra})

        return build, sources

    def refresh(self, name: str, as_of: datetime, full_refresh: bool = False) -> None:
        """Run one incremental model."""
        model = INCREMENTAL[name]
        build, sources = self._plan(name, as_of)
        if self.track_late and model in INTERMEDIATE:
            self._judge_late(model, sources, full_refresh)
        marked = self._announce(name)
        self.written[name] = inc.refresh(
            self.spark, self.root, model.table, build, sources, model.restrictions, full_refresh, self.compare_existing,
            unique=True,  # the builders of ranked tables keep one row of each key
        )
        if self.key_marks:
            self._mark_keys(name, marked)

    def _marks_path(self, name: str) -> str:
        return f"{self.root}/_marks/{name}-{self.mark_slots}"

    def _announce(self, name: str) -> bool:
        """Note that the table is about to change; returns whether its marks are those of the stored rows until then.

        A note that is still there tells that rows were written and not marked.
        """
        path = self._marks_path(name)
        kept = paths.has_data(self.spark, path)
        marked = kept and not paths.exists(self.spark, f"{path}/{UNMARKED}")
        if kept or self.key_marks:
            paths.touch(self.spark, f"{path}/{UNMARKED}")
        return marked

    def _mark_keys(self, name: str, marked: bool) -> None:
        table, path = INCREMENTAL[name].table, self._marks_path(name)
        whole = not marked or self.written[name] is None
        rows = self.table(name) if whole else self._written_part(name)
        keymarks.refresh_marks(self.spark, path, rows, table.key, table.partition, self.mark_slots, whole)
        paths.remove(self.spark, f"{path}/{UNMARKED}")

    def repeated_keys(self, name: str, column: str) -> DataFrame | None:
        """Keys of the days written last that occur more than once in the whole table; None where no marks tell."""
        table = INCREMENTAL[name].table if name in INCREMENTAL else None
        days, path = self.written.get(name), self._marks_path(name)
        if table is None or column != table.key or days is None or not paths.has_data(self.spark, path):
            return None
        at = F.col(table.partition)
        marks = keymarks.stored_marks(self.spark, path, table.partition).filter(~paths.on_days(at, days))
        history = self.table(name).filter(~paths.on_days(at, days))
        return keymarks.duplicate_new_keys(
            self.spark, self._written_part(name), history, marks, column, table.partition, self.mark_slots
        )

    def _judge_late(self, model: Model, sources: dict[str, DataFrame], full_refresh: bool) -> None:
        """Late rows are judged before the run moves the mark."""
        (arg, source), table = next(iter(model.inputs.items())), model.table
        if full_refresh:
            self.late(table.name).reset(sources[arg])
            return
        bound = inc.lookback_bound(inc.high_water_mark(self.spark, self.root, table), table.lookback)
        base = landing.landing_path(self.root, source.removeprefix("staging:"))
        self.late(table.name).judge(sources[arg], base, model.restrictions[arg].column, bound, table.inclusive)

    def late(self, name: str) -> Ledger:
        """The ledger of late rows of an intermediate table."""
        return Ledger(self.root, name)

    def reconcile(self, name: str) -> DataFrame:
        """Per day: landed rows that are stored, superseded, late or without a key. Landing must not be pruned."""
        model = INCREMENTAL[name]
        _, source = next(iter(model.inputs.items()))
        feed = source.removeprefix("staging:")
        staged = build_staging(landing.read_landing(self.spark, self.root, feed), self.mappings[feed])
        ranking, usable = model.table.ranking, F.col("city").isNotNull()
        if "incident_id" in ranking.keys:
            usable = usable & F.col("incident_id").isNotNull()
        at = "forecast_at" if "forecast_at" in ranking.keys else "observed_at"
        derived = {
            model.table.partition: F.to_date(at), "hour_utc": F.hour(at), "issued_at": F.col("extracted_at").cast("timestamp_ntz"),
        }
        landed = staged.withColumns({c: e for c, e in derived.items() if c in (*ranking.keys, model.table.partition)})
        landed = landed.select("raw_id", *dict.fromkeys([*ranking.keys, model.table.partition, "city"]))
        return reconcile(
            landed, self.late(name).rows(self.spark), self.table(name), ranking.keys, model.table.partition, usable
        )

    def rebuild(self, name: str, as_of: datetime) -> None:
        """Rebuild one table in full."""
        t = self.table
        built = {
            "dim_city": lambda: m.dim_city(t("int_city_hourly_weather"), t("int_city_hourly_traffic_flow")),
            "dim_date": lambda: dims.dim_date(self.spark, self.calendar_start, as_of.date() + CALENDAR_AHEAD),
            "dim_hour": lambda: dims.dim_hour(self.spark),
            "mart_city_daily": lambda: m.city_daily(
                t("fct_weather_daily"), t("fct_pollution_daily"), t("fct_traffic_daily"), t("dim_city")
            ),
            "mart_forecast_latest": lambda: m.forecast_latest(t("int_city_weather_forecast"), as_of),
            "mart_temperature_trends": lambda: m.temperature_trends(t("fct_weather_daily")),
            "mart_weather_alerts": lambda: m.weather_alerts(t("mart_forecast_latest")),
        }
        inc.rebuild(built[name](), self.root, "marts", name)

    def refresh_rolling(self, name: str, as_of: datetime) -> list[str] | None:
        """Compute again what the days that the facts last wrote can reach; returns the days it wrote (None: all).

        A rolling mart that is absent, or one of whose facts was loaded whole, is built in full.
        """
        model = ROLLING[name]
        table, by, at = model.table, "city", model.table.partition
        facts = {arg: self.table(source) for arg, source in model.inputs.items()}
        cities = {"cities": self.table("dim_city")} if model.lent else {}
        written = [self.written.get(source) for source in model.inputs.values()]
        stored = paths.partition_values(self.spark, self.path(name), at)
        if not stored or any(days is None for days in written):
            batch = model.build(**facts, **cities)
            inc.replace_table(self.spark, batch, self.path(name), at)
            self._keep_lent(model, name)
            return None
        changed = sorted({date.fromisoformat(d) for days in written for d in days if d != paths.NULL_VALUE})
        days = sorted({
            date.fromisoformat(d)
            for source in model.inputs.values() for d in paths.partition_values(self.spark, self.path(source), at) if d != paths.NULL_VALUE
        })
        timeline = reduce(DataFrame.unionByName, [f.select(by, at) for f in facts.values()])
        if len(facts) > 1:
            timeline = timeline.distinct()
        batches = []
        for span in spans_to_read(timeline, days, changed, by, at, model.reach):
            touched = touched_rows(timeline, span, by, at, model.reach)
            recent = {arg: f.filter(span.holds(at)) for arg, f in facts.items()}
            batches.append(model.build(**recent, **cities).join(touched, [by, at], "left_semi"))
        renamed = self._lent_changes(model, name) if model.lent else None
        if renamed is not None:
            whole = {arg: f.join(renamed, by, "left_semi") for arg, f in facts.items()}
            batches = [b.join(renamed, by, "left_anti") for b in batches] + [model.build(**whole, **cities)]
        if not batches:
            return []
        wrote = inc.delete_insert(self.spark, self.root, table, reduce(DataFrame.unionByName, batches))
        self._keep_lent(model, name)
        return wrote

    def _lent_path(self, name: str) -> str:
        return f"{self.root}/_lent/{name}"

    def _keep_lent(self, model: Rolling, name: str) -> None:
        if model.lent:
            kept = self.table("dim_city").select("city", *model.lent)
            kept.coalesce(1).write.mode("overwrite").parquet(self._lent_path(name))

    def _lent_changes(self, model: Rolling, name: str) -> DataFrame | None:
        """Cities whose lent attributes are not those of the last run; None when there are none."""
        now = self.table("dim_city").select("city", F.struct(*model.lent).alias("_now"))
        then = self.spark.read.parquet(self._lent_path(name)).select("city", F.struct(*model.lent).alias("_then"))
        differ = now.join(then, "city", "full").filter(~F.col("_now").eqNullSafe(F.col("_then"))).select("city")
        return None if differ.isEmpty() else differ

    def _require_landing(self) -> None:
        """Landing must reach back as far as each stored intermediate table that is fed from it."""
        for model in INTERMEDIATE:
            name = model.table.name
            stored = paths.partition_values(self.spark, self.path(name), model.table.partition)
            stored = [d for d in stored if d != paths.NULL_VALUE]
            for source in model.inputs.values():
                feed = source.removeprefix("staging:")
                if feed == source or not stored:
                    continue
                landed = paths.partition_values(self.spark, landing.landing_path(self.root, feed), landing.PARTITION)
                if not landed or landed[0] > stored[0]:
                    raise ValueError(f"{name} has days from {stored[0]} on, landing of {feed} does not: a rebuild loses them")

    def _together(self, jobs: list[Callable[[], None]], threads: int) -> None:
        """Submit independent models from a few threads, so that small ones overlap on the cluster."""
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs]:
                done.result()

    def _written_part(self, name: str) -> DataFrame:
        """The days of a table that its last run wrote; a key lies in one day, so they can be tested alone."""
        days = self.written.get(name)
        if name not in INCREMENTAL or days is None:
            return self.table(name)
        return self.table(name).filter(paths.on_days(F.col(INCREMENTAL[name].table.partition), days))

    def test(self, suite: dict[str, TableTests], scope: str = "all") -> DataFrame:
        """Schema tests of whole tables, or with ``written`` of the days written last."""
        read = self._written_part if scope == "written" else self.table
        parents = {parent for tests in suite.values() for _, parent, _ in tests.relationships}
        tables = {n: self.table(n) for n in parents - set(suite)} | {n: read(n) for n in suite}
        marked = scope == "written" and self.key_marks
        return run_tests(tables, suite, self.repeated_keys) if marked else run_tests(tables, suite)

    def _require(self, suite: dict[str, TableTests], scope: str) -> None:
        if scope == "none":
            return
        failed = self.test(suite, scope).filter("violations > 0").collect()
        if failed:
            lines = [f"  - {r['table_name']}.{r['column_name']} {r['test']}: {r['violations']}" for r in failed]
            raise SchemaTestError("schema tests failed:\n" + "\n".join(sorted(lines)))

    def run(
        self,
        as_of: datetime,
        config: dict[str, DataFrame] | None = None,
        run_id: str | None = None,
        full_refresh: bool | str = False,
        threads: int = 4,
        validate: bool = True,
        test: str = "written",
    ) -> contract.ContractResult | None:
        """Gate, then intermediate, then marts, each layer followed by its schema tests.

        ``test`` is the scope of the schema tests: the days just ``written``, ``all`` rows, or ``none``.
        ``full_refresh`` rebuilds the ``"marts"`` (also: True) from the intermediate tables. Those hold more than
        landing does, so they are rebuilt only by ``"all"``, which refuses to drop days that landing no longer
        has; ``"all_and_drop"`` does drop them.
        """
        scope = "marts" if full_refresh is True else full_refresh or "none"
        if scope not in ("none", "marts", "all", "all_and_drop"):
            raise ValueError(f"unknown scope of a full refresh: {full_refresh}")
        if scope == "all":
            self._require_landing()
        result = None
        if config is not None:
            cfg.check_config(config)
            self.mappings = {feed: cfg.all_mappings(config, feed) for feed in FEEDS}
            if validate:
                result = contract.gate(self.spark, self.root, config, as_of, run_id)

        def incremental(*names: str) -> list[Callable[[], None]]:
            whole = scope.startswith("all") or scope == "marts" and not names[0].startswith("int_")
            return [lambda n=n: self.refresh(n, as_of, whole) for n in names]

        def rebuilt(*names: str) -> list[Callable[[], None]]:
            return [lambda n=n: self.rebuild(n, as_of) for n in names]

        def rolled(*names: str) -> list[Callable[[], None]]:
            return [lambda n=n: self.refresh_rolling(n, as_of) for n in names] if self.bounded_marts else rebuilt(*names)

        self._together(incremental(*[x.table.name for x in INTERMEDIATE]), threads)
        self._require(INTERMEDIATE_TESTS, test)
        self._together(
            rebuilt(*DIMENSIONS, "mart_forecast_latest") + incremental(*[x.table.name for x in FACTS]), threads
        )
        self._together(
            rolled("mart_city_daily", "mart_temperature_trends") + rebuilt("mart_weather_alerts")
            + incremental("mart_pollution_alerts"),
            threads,
        )
        self._require(MART_TESTS, test)
        return result

    def backfill(self) -> dict[str, int]:
        """Recompute the stored keys of the intermediate tables; safe to repeat."""
        for name in BACKFILL_KEYS:
            self._announce(name)
        return {
            name: inc.rewrite_keys(self.spark, self.root, INCREMENTAL[name].table, key())
            for name, key in BACKFILL_KEYS.items()
        }

    def prune_landing(self, as_of: datetime) -> None:
        for feed in FEEDS:
            ledgers = [self.late(x.table.name) for x in INTERMEDIATE if self.track_late and f"staging:{feed}" in x.inputs.values()]
            before = self._landing_files(feed) if ledgers else set()
            landing.prune(self.spark, self.root, feed, as_of)
            for ledger in ledgers:
                ledger.rewritten(self.spark, before, self._landing_files(feed))

    def _landing_files(self, feed: str) -> set[str]:
        if not paths.has_data(self.spark, landing.landing_path(self.root, feed)):
            return set()
        return set(map(unquote, landing.read_landing(self.spark, self.root, feed).inputFiles()))
