"""Raw JSON text -> typed flow records, with the bad ones set aside.

Stateless column expressions only: works on batch and streaming frames alike and
adds no exchange. Each record is read once into natively typed fields. Only where
that leaves a gap (a missing key, text in a number, a fraction in an integer) it
is read a second time as VARIANT under the lenient rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coercion import lenient_number
from ..functions.fence import fence
from ..functions.schema import FEATURES, MEANS, N_FEATURES, UNKNOWN_HOST, Feature

_CORRUPT = "_corrupt_record"
# "NaN" and "Infinity" outside quotes are no JSON.
_OPTIONS = {"allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}
_CONTEXT = ("source_ip", "destination_ip", "attackType", "timestamp", "probe")
_KEYS = [f.key for f in FEATURES]
_ALIASES = [f.alias for f in FEATURES if f.alias]


def _names(prefix: str, keys: list[str]) -> dict[str, str]:
    return {k: f"{prefix}{i}" for i, k in enumerate(keys)}


def _expand(df: DataFrame, value: str, kinds: dict[str, str], names: dict[str, str]) -> DataFrame:
    """Read ``value`` as a record of ``kinds`` (JSON key -> type) into columns ``names``."""
    ddl = ", ".join(f"`{k}` {t}" for k, t in kinds.items())
    options = ", ".join(f"'{k}', '{v}'" for k, v in _OPTIONS.items())
    renamed = ", ".join(f"{names[k]}: {t}" for k, t in kinds.items())
    record = f"from_json({value}, '{ddl}', map({options}))"
    # a generator, for the reason given at functions.fence
    return df.selectExpr("*", f"inline(array(CAST({record} AS struct<{renamed}>)))")


def read_records(df: DataFrame, *, aliases: bool = True, value: str = "value") -> DataFrame:
    """Add the 52 feature columns, the context columns and ``parse_error``.

    ``parse_error`` is NULL for a good record, else ``null_record``, ``malformed_json``, ``probe``,
    ``missing:<heading>`` or ``overflow:<heading>`` for the first such feature;
    ``missing_features`` lists the headings of all absent ones.
    """
    context = {k: "string" for k in (*_CONTEXT, _CORRUPT)}
    strict_kinds = {**{f.key: f.kind for f in FEATURES}, **context}
    lenient_keys = _KEYS + (_ALIASES if aliases else [])
    lenient_kinds = {**{k: "variant" for k in lenient_keys}, **context}
    s, l = _names("_s", list(strict_kinds)), _names("_l", list(lenient_kinds))

    text = f"`{value}`"
    first = _expand(df, text, strict_kinds, s)
    complete = " AND ".join(f"{s[k]} IS NOT NULL" for k in _KEYS)
    marked = first.selectExpr("*", f"NOT ({complete} AND {s[_CORRUPT]} IS NULL) AS _again")
    both = _expand(marked, f"CASE WHEN _again THEN {text} END", lenient_kinds, l)

    def raw(f: Feature) -> str:
        return f"coalesce({l[f.key]}, {l[f.alias]})" if aliases and f.alias else l[f.key]

    def either(key: str) -> str:
        return f"coalesce({s[key]}, {l[key]})"

    malformed = f"({text} IS NULL OR {l[_CORRUPT]} IS NOT NULL OR trim({text}) = '')"
    absent = ", ".join(f"CASE WHEN {raw(f)} IS NULL THEN '{f.key}' END" for f in FEATURES)
    typed = fence(
        both,
        drop=(*s.values(), *l.values()),
        **{f.column: f"coalesce({s[f.key]}, {lenient_number(raw(f), f.kind)})" for f in FEATURES},
        source_ip=f"coalesce({either('source_ip')}, '{UNKNOWN_HOST}')",
        destination_ip=f"coalesce({either('destination_ip')}, '{UNKNOWN_HOST}')",
        attack_label=either("attackType"),
        event_ms=f"try_cast({either('timestamp')} AS bigint)",
        missing_features=(
            f"CASE WHEN _again AND NOT {malformed} THEN array_compact(array({absent}))"
            " ELSE CAST(array() AS array<string>) END"
        ),
        _malformed=f"_again AND {malformed}",
        _absent=f"{text} IS NULL",
        _probe=f"coalesce({l['probe']}, '') = 'true'",
    )
    overflow = ", ".join(
        f"CASE WHEN {f.column} IS NULL THEN 'overflow:{f.key}' END" for f in FEATURES
    )
    return fence(
        typed,
        drop=("_again", "_malformed", "_probe", "_absent"),
        parse_error=(
            "CASE WHEN _absent THEN 'null_record' WHEN NOT _again THEN CAST(NULL AS string) "
            "WHEN _malformed THEN 'malformed_json' "
            "WHEN size(missing_features) > 0 "
            "THEN CASE WHEN _probe THEN 'probe' ELSE concat('missing:', missing_features[0]) END "
            f"ELSE coalesce({overflow}) END"
        ),
    )


def impute_missing(records: DataFrame) -> DataFrame:
    """Fill absent features with the trained mean, which scales to zero, and clear the error.

    Opt-in: records of the traffic generator lack 12 of the 52 features and are
    otherwise set aside. Probes, malformed and overflowing records stay as they are.
    """
    fills = {
        f.column: (
            f"CASE WHEN parse_error LIKE 'missing:%' AND array_contains(missing_features, '{f.key}')"
            f" THEN CAST({m!r}D AS {f.kind}) ELSE {f.column} END"
        )
        for f, m in zip(FEATURES, MEANS)
    }
    complete = " AND ".join(f"{f.column} IS NOT NULL" for f in FEATURES)
    return fence(
        fence(records, **fills),
        parse_error=(
            f"CASE WHEN parse_error LIKE 'missing:%' AND {complete}"
            " THEN CAST(NULL AS string) ELSE parse_error END"
        ),
    )


def parse_flows(
    df: DataFrame, *, aliases: bool = True, impute: str | None = None, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """``(flows, quarantine)``: typed good records, and raw text plus reason of the rest."""
    records = read_all(df, aliases=aliases, impute=impute, value=value)
    kept = [c for c in df.columns if c != value]
    flows = records.filter(F.col("parse_error").isNull()).drop("parse_error", value)
    bad = records.filter(F.col("parse_error").isNotNull())
    return flows, bad.select(*kept, value, "parse_error", "missing_features")


def read_all(
    df: DataFrame, *, aliases: bool = True, impute: str | None = None, value: str = "value"
) -> DataFrame:
    """All records, good and bad, with absent features filled if asked for."""
    if impute not in (None, "mean"):
        raise ValueError(f"unknown imputation {impute!r}")
    records = read_records(df, aliases=aliases, value=value)
    return impute_missing(records) if impute else records


def bad_length(vector: Column, n: int = N_FEATURES) -> Column:
    """Reason ``bad_length`` if a vector has not exactly ``n`` elements, else NULL."""
    return F.when(F.coalesce(F.size(vector), F.lit(-1)) != n, F.lit("bad_length"))
