"""The layered tables under one root folder, built in order and each stored once.

raw -> bronze -> silver -> dimensions -> fact -> claims, presentation table.
Every layer is written as Parquet and the next one reads the stored table, so a
lost executor costs tasks, never layers, and no layer is computed twice.

Each build of a table has a folder of its own. Readers (``open_gold``,
``open_table``) follow the published version, which is switched in one step when a
build is whole: one that dies in any layer leaves what they see as it was.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starfold import rules as defaults
from starfold.operators import (
    LIMITS,
    CleanSpec,
    Limits,
    build_fact,
    build_factor_dim,
    build_location_dim,
    build_time_dim,
    build_vehicle_dim,
    clean,
    copy_limits,
    generate_claims,
    may_broadcast,
    natural_hot_keys,
    present,
    run_checks,
    surrogate_hot_keys,
)
from starfold.plans.catalog import Gold
from starfold.sources.delimited import read_csv
from starfold.sources.tables import is_complete, read_note, read_optional, read_table, stored_rows, write_note, write_table
from starfold.sources.versions import current_version, files_digest, input_digest, publish_version, version_paths

DIMENSIONS = ("dim_time", "dim_location", "dim_vehicle", "dim_factor")
LAYOUT = {
    "bronze": "bronze/collisions",
    "silver": "silver/collisions",
    "dim_time": "gold/dim_time",
    "dim_location": "gold/dim_location",
    "dim_vehicle": "gold/dim_vehicle",
    "dim_factor": "gold/dim_factor",
    "fact_collisions": "gold/fact_collisions",
    "fact_claims": "gold/fact_claims",
    "presentation": "gold/presentation",
}


#: The tables that each table reads.
INPUTS = {
    "bronze": (),
    "silver": ("bronze",),
    **{name: ("silver",) for name in DIMENSIONS},
    "fact_collisions": ("silver", *DIMENSIONS),
    "fact_claims": ("fact_collisions",),
    "presentation": ("fact_collisions", *DIMENSIONS),
}


@dataclass(frozen=True)
class Rules:
    """What the layers are built by. The defaults describe the collision tables."""

    clean: CleanSpec = CleanSpec()
    claims: defaults.ClaimRules = defaults.ClaimRules()
    bands: Sequence[tuple[int, int, str]] = defaults.TIME_BANDS
    last_band: str = defaults.LAST_BAND
    vehicles: Sequence[tuple[str, str]] = defaults.VEHICLE_RULES
    factors: Sequence[tuple[str, str]] = defaults.FACTOR_RULES
    factor_default: str = defaults.FACTOR_DEFAULT
    key_type: str = "int"


@dataclass
class Lake:
    """Tables under ``root``. ``raw`` gives the untyped-to-typed input of the bronze layer.

    ``table`` builds what is asked for, and what that needs, the first time; so do the tables
    of ``on_demand``. ``run`` and ``gold`` publish what was built. Each table gets a build id and a note of it, of the settings it was built
    by and of the build ids of what it was built from. ``resume=True`` takes up a completely stored
    table only when its note agrees with all of these, so what stands below a
    rebuilt table is rebuilt too.

    ``source`` tells one raw input from another: a text, or a function that gives one. Without
    it the files that ``raw`` reads count, by path, length and modification time; a ``raw`` that reads no
    files is never taken up.
    """

    spark: SparkSession
    root: str
    raw: Callable[[], DataFrame]
    null_safe: bool = False
    seed: str = ""
    limits: Limits = LIMITS
    resume: bool = False
    rules: Rules = Rules()
    source: str | Callable[[], str] | None = None
    _built: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _notes: dict[str, dict] = field(default_factory=dict, repr=False)
    _rows: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str, path: str | list[str], **options) -> Lake:
        return cls(spark, root, lambda: read_csv(spark, path), source=lambda: f"{json.dumps(path)} {files_digest(spark, path)}", **options)

    def _under(self, place: str) -> str:
        return f"{self.root.rstrip('/')}/{place}"

    def path(self, name: str) -> str:
        """Folder of the build of a table that this lake uses."""
        self.table(name)
        return self._notes[name]["path"]

    def build_id(self, name: str) -> str:
        self.table(name)
        return self._notes[name]["id"]

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            inputs = {needed: self.build_id(needed) for needed in INPUTS[name]}
            wanted = {"settings": self._settings(name), "inputs": inputs}
            note = read_note(self.spark, self._note(name)) if self.resume else None
            if note and {k: note.get(k) for k in wanted} == wanted and is_complete(self.spark, note["path"]):
                self._built[name] = read_table(self.spark, note["path"])
            else:
                made = uuid.uuid4().hex
                note = {"id": made, "path": self._under(f"{LAYOUT[name]}/{made}"), **wanted}
                self._built[name] = write_table(self._frame(name), note["path"])
                write_note(self.spark, self._note(name), note)
            self._notes[name] = note
        return self._built[name]

    def publish(self) -> None:
        """Let readers see the tables built or taken up here, together with those published before that were built from them."""
        before = (current_version(self.spark, self.root.rstrip("/")) or {}).get("tables", {})
        tables = dict(self._notes)
        for name in LAYOUT:
            old = before.get(name)
            if name not in tables and old and all(i in tables and tables[i]["id"] == key for i, key in old["inputs"].items()):
                tables[name] = old
        if tables != before:
            publish_version(self.spark, self.root.rstrip("/"), {"tables": tables})

    def _note(self, name: str) -> str:
        """Place of the note of the last whole build of a table, published or not."""
        return self._under(f"_builds/{name}.json")

    def hot_keys(self, limits: Limits | None = None) -> dict[str, list[int]]:
        """Hot natural keys of silver, and hot row ids (``id``): found once by one profile, and kept beside the build of silver."""
        silver, limits = self.table("silver"), limits or self.limits
        wanted = copy_limits(self.spark, limits)
        if stored_rows(silver) < wanted.hot_rows:
            return {}  # too few rows for a hot key
        place = self._under(f"_builds/hot-{self.build_id('silver')}-{wanted.hot_keys}-{wanted.hot_rows}.json")
        kept = read_note(self.spark, place)
        if kept is None:
            kept = natural_hot_keys(silver, self.dims(), {"id": ["collision_id"]}, limits=wanted)
            write_note(self.spark, place, kept)
        return kept

    def fact(self, *, null_safe: bool | None = None, limits: Limits | None = None) -> DataFrame:
        """The fact, not stored, from the stored silver and dimensions, by the hot keys kept with silver."""
        limits, dims = limits or self.limits, self.dims()
        every = all(may_broadcast(dim, dim.columns, limits) for dim in dims.values())
        hot = {} if every else self.hot_keys(limits)
        return build_fact(self.table("silver"), dims, null_safe=self.null_safe if null_safe is None else null_safe, hot=hot, limits=limits)

    def _settings(self, name: str) -> str:
        """Digest of the settings that decide the content of a table."""
        r = self.rules
        keys = {"bands": r.bands, "last": r.last_band, "vehicles": r.vehicles, "factors": r.factors, "default": r.factor_default}
        own = {
            "bronze": self._source() if name == "bronze" else "",
            "silver": asdict(r.clean),
            "dim_time": [keys["bands"], keys["last"], r.key_type],
            "dim_location": r.key_type,
            "dim_vehicle": [keys["vehicles"], r.key_type],
            "dim_factor": [keys["factors"], keys["default"], r.key_type],
            "fact_collisions": self.null_safe,
            "fact_claims": [self.seed, asdict(r.claims)],
            "presentation": "",
        }[name]
        return hashlib.sha256(json.dumps(own, sort_keys=True, default=str).encode()).hexdigest()

    def _source(self) -> str:
        """What tells this raw input from another; without anything to tell it by, a value that no other build has."""
        given = self.source() if callable(self.source) else self.source
        if given is None:
            given = input_digest(self._raw_rows())
        return uuid.uuid4().hex if given is None else given

    def _raw_rows(self) -> DataFrame:
        """The raw input, asked for once: making its plan may take passes over the tables it is derived from."""
        if self._rows is None:
            self._rows = self.raw()
        return self._rows

    def _frame(self, name: str) -> DataFrame:
        if name == "bronze":
            return self._raw_rows()
        if name == "silver":
            return clean(self.table("bronze"), self.rules.clean)
        if name in DIMENSIONS:
            silver, r = self.table("silver"), self.rules
            common = {"key_type": r.key_type, "limits": self.limits}
            if name == "dim_time":
                return build_time_dim(silver, bands=r.bands, last_band=r.last_band, **common)
            if name == "dim_location":
                return build_location_dim(silver, **common)
            if name == "dim_vehicle":
                return build_vehicle_dim(silver, r.vehicles, **common)
            return build_factor_dim(silver, r.factors, r.factor_default, **common)
        if name == "fact_collisions":
            return self.fact()
        fact, hot = self.table("fact_collisions"), self.hot_keys()
        if name == "fact_claims":
            return generate_claims(fact, self.seed, self.rules.claims, hot=hot.get("id", []), limits=self.limits)
        return present(fact, self.dims(), hot=surrogate_hot_keys(hot, self.dims()), limits=self.limits)

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in DIMENSIONS}

    def gold(self, *, claims: bool = True) -> Gold:
        """The star schema, published; without claims those queries are simply not available."""
        made = Gold(
            self.table("fact_collisions"),
            *self.dims().values(),
            self.table("fact_claims") if claims else None,
            self.limits,
        )
        self.publish()
        return made

    def on_demand(self) -> Gold:
        """The star schema for a query that reads a part of it; nothing is published."""
        return GoldOnDemand(self)

    def checks(self, *, claims: bool = True) -> DataFrame:
        """The quality checks over silver and gold."""
        return run_checks({"silver": self.table("silver"), **self.gold(claims=claims).tables()})

    def run(self) -> DataFrame:
        """Build every layer in order, publish them, then return the quality checks."""
        for name in LAYOUT:
            self.table(name)
        return self.checks()


class GoldOnDemand(Gold):
    """The star schema of a lake whose tables are each built when they are first read."""

    fact_collisions, dim_time, dim_location, dim_vehicle, dim_factor, fact_claims = (
        property(lambda self, name=name: self._lake.table(name)) for name in ("fact_collisions", *DIMENSIONS, "fact_claims")
    )

    def __init__(self, lake: Lake):
        object.__setattr__(self, "_lake", lake)
        object.__setattr__(self, "limits", lake.limits)


def _published(spark: SparkSession, root: str) -> dict[str, str]:
    """Folders of the current version; of a folder without versions, the plain ones."""
    root = root.rstrip("/")
    content = current_version(spark, root)
    return version_paths(content) if content else {name: f"{root}/{place}" for name, place in LAYOUT.items()}


def open_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the version published under ``root``."""
    paths = _published(spark, root)
    if name not in paths:
        raise LookupError(f"{name} is not in the version published under {root}")
    return read_table(spark, paths[name])


def open_gold(spark: SparkSession, root: str, limits: Limits = LIMITS) -> Gold:
    """The star schema published under ``root``, all of one version.

    ``fact_claims`` may be absent: claims made from another build of the fact are not in the version.
    """
    paths = _published(spark, root)
    claims = read_optional(spark, paths["fact_claims"]) if "fact_claims" in paths else None
    return Gold(*[read_table(spark, paths[name]) for name in ("fact_collisions", *DIMENSIONS)], claims, limits)
