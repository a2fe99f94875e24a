"""Schema versions: a table of DDL, a check of what a new version changes, and records of all versions typed as the last one.

A version names its fields by DDL and says which of them were called otherwise before. It is registered only if every record
of the versions before it can still be read: fields may be added, dropped, renamed or widened, but not narrowed or retyped,
and a field that must not be null can be neither added nor dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cinderlog.functions import kept_apart, quoted, quoted_list

REGISTRY = "place int, version string, ddl string, renames map<string,string>"
#: Registered versions; each adds a branch to the expression that reads records.
MAX_VERSIONS = 200
_WIDER = ("tinyint", "smallint", "int", "bigint", "double")
_CORRUPT = "_corrupt_record"


class IncompatibleSchema(ValueError):
    """A new version could not read the records of an earlier one."""


@dataclass(frozen=True)
class Version:
    """`renames` has old names and what they are called from this version on."""

    version: str
    ddl: str
    renames: dict[str, str] = field(default_factory=dict)

    @property
    def fields(self) -> dict[str, T.StructField]:
        return {f.name: f for f in T.StructType.fromDDL(self.ddl).fields}


def _widens(old: str, new: str) -> bool:
    if old in _WIDER and new in _WIDER:
        # a double holds whole numbers of up to 53 bits, so a bigint is not widened by it
        return _WIDER.index(old) <= _WIDER.index(new) and (old, new) != ("bigint", "double")
    return (old, new) in {("float", "double"), ("date", "timestamp")} or (new == "string" and old in (*_WIDER[:4], "boolean", "date"))


def changes(old: Version, new: Version) -> list[tuple[str, str, bool]]:
    """What a version changes: field, kind of change and whether records of the old version can still be read."""
    before, after, found = old.fields, new.fields, []
    for was in sorted(set(new.renames) - set(before)):
        found.append((was, "renames nothing", False))
    for name, held in before.items():
        now = after.get(new.renames.get(name, name))
        if now is None:
            found.append((name, "dropped", held.nullable))
            continue
        if now.name != name:
            found.append((name, f"renamed to {now.name}", True))
        kinds = held.dataType.simpleString(), now.dataType.simpleString()
        if kinds[0] != kinds[1]:
            wider = _widens(*kinds)
            found.append((now.name, f"{'widened' if wider else 'retyped'} from {kinds[0]} to {kinds[1]}", wider))
        if held.nullable and not now.nullable:
            found.append((now.name, "not null any more", False))
    known = {new.renames.get(name, name) for name in before}
    found += [(name, "added", f.nullable) for name, f in after.items() if name not in known]
    return found


def read_registry(spark: SparkSession, path: str) -> list[Version]:
    """The versions at `path`, in the order in which they were registered; none if nothing was registered."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    rows = spark.read.schema(REGISTRY).parquet(path).orderBy("place").limit(MAX_VERSIONS + 1).collect()
    return [Version(r["version"], r["ddl"], dict(r["renames"])) for r in rows]


def register(spark: SparkSession, path: str, new: Version) -> list[tuple[str, str, bool]]:
    """Add a version, or refuse it; returns what it changes.

    Every version has a folder of its own, which is written only if it isn't there, so of two registrations at once one fails.
    """
    known = read_registry(spark, path)
    if new.version in {v.version for v in known}:
        raise ValueError(f"version {new.version} is registered already")
    if len(known) >= MAX_VERSIONS:
        raise ValueError(f"more than {MAX_VERSIONS} versions")
    found = changes(known[-1], new) if known else []
    bad = [f"{name} {kind}" for name, kind, fine in found if not fine]
    if bad:
        raise IncompatibleSchema(f"version {new.version}: {', '.join(bad)}")
    row = spark.createDataFrame([(new.version, new.ddl, new.renames)], "version string, ddl string, renames map<string,string>")
    row.coalesce(1).write.mode("errorifexists").parquet(f"{path}/place={len(known)}")
    return found


def _last_names(versions: list[Version], at: int) -> dict[str, str]:
    """Name in the last version -> name in version `at`, of the fields that both have."""
    names = {name: name for name in versions[at].fields}
    for later in versions[at + 1:]:
        moved = {was: later.renames.get(now, now) for was, now in names.items()}
        names = {was: now for was, now in moved.items() if now in later.fields}
    return {now: was for was, now in names.items()}


def bind_versions(df: DataFrame, version: Column, versions: list[Version], value: str = "value") -> DataFrame:
    """Add `record`, typed as the last version, and `reason`, which is NULL if the record is valid.

    Each record is read by the schema of its own version and its fields widened to the last one's. Reasons, in this order:
    `unknown_version`, `not_json_object`, `unknown_field`, `type_mismatch`, `missing_field` (null where it must not be).
    """
    last, text = versions[-1].fields, f"`{value}`"
    read, reason, typed = [], [], []
    for at, v in enumerate(versions):
        case, names = f"WHEN _version = {quoted(v.version)} THEN", _last_names(versions, at)
        schema = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in v.fields.items())
        parsed = f"from_json({text}, {quoted(f'{schema}, {_CORRUPT} string')}, map('columnNameOfCorruptRecord', '{_CORRUPT}'))"
        read.append((case, parsed))
        needed = " OR ".join([f"_r{at}.`{n}` IS NULL" for n, f in v.fields.items() if not f.nullable] or ["false"])
        reason.append(
            f"{case} CASE WHEN size(array_except(_keys, array({quoted_list(v.fields)}))) > 0 THEN 'unknown_field' "
            f"WHEN _r{at}.{_CORRUPT} IS NOT NULL THEN 'type_mismatch' WHEN {needed} THEN 'missing_field' END"
        )
        values = (
            f"{quoted(n)}, CAST({f'_r{at}.`{names[n]}`' if n in names else 'NULL'} AS {f.dataType.simpleString()})"
            for n, f in last.items()
        )
        typed.append(f"{case} named_struct({', '.join(values)})")
    known = quoted_list(v.version for v in versions)
    keys = f"map_keys(try_variant_get(try_parse_json({text}), '$', 'map<string,variant>'))"
    rows = df.withColumn("_version", version.cast("string")).selectExpr("*", f"{kept_apart(keys)} AS _keys")
    rows = rows.selectExpr("*", *[f"CASE {case} {parsed} END AS _r{at}" for at, (case, parsed) in enumerate(read)])
    judged = (
        f"CASE WHEN _version IS NULL OR _version NOT IN ({known}) THEN 'unknown_version' "
        f"WHEN _keys IS NULL THEN 'not_json_object' ELSE CASE {' '.join(reason)} END END"
    )
    rows = rows.selectExpr("*", f"{kept_apart(judged)} AS reason")
    return rows.selectExpr(
        *[f"`{c}`" for c in df.columns], f"CASE WHEN reason IS NULL THEN CASE {' '.join(typed)} END END AS record", "reason"
    )
