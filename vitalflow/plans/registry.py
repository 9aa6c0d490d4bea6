"""The registered queries: one per operator, each over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, TimestampNTZType, TimestampType

from .. import schemas as S
from ..operators import cohort, events, feature_state, features, metrics, models, name_index, quality, risk, silver, state
from ..operators import gold as G
from ..streaming import confirm
from .proxy import AS_OF, ENTITY_TYPES, TARGET_PATTERNS, Clinic

Query = Callable[[SparkSession, str], DataFrame]


def render(df: DataFrame) -> DataFrame:
    """Dates as text, doubles rounded, integers wide: values that engines print alike."""

    def shown(field):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, DoubleType):
            c = F.round(c, 6)
        elif isinstance(kind, IntegerType):
            c = c.cast("bigint")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


QUERIES: dict[str, Query] = {}


#: Entities whose lines a query that reads several of them, or reads them several times, joins once.
_ALL = (*ENTITY_TYPES, "observations")
JOINED = dict.fromkeys(
    """null_profile null_profile_pct merged_profile duplicate_rows layer_report
    clinical_timeline timeline_filtered timeline_day_breaks timeline_counts""".split(),
    _ALL,
)
JOINED["interval_anomalies"] = ("conditions", "medications", "allergies", "careplans")
JOINED |= dict.fromkeys(
    """obt_patient_encounters patient_features incremental_features feature_contract features_ablated features_long
    activity_counts features_asof features_buffered features_targets_long features_for_target median_impute onehot
    train_score train_score_rows feature_importance importance_rows experiment_comparison comparison_rows
    risk_scores risk_scores_rows patient_risk trained_registry registry_keys patient_360""".split(),
    ("conditions", "medications", "observations"),
)
JOINED |= dict.fromkeys(
    """silver_observations reading_seq observations_pivot reading_base gold_observations make_observation_events
    latest_obs_hist observations_long vital_averages reading_flags""".split(),
    ("observations",),
)


#: Queries that read the wide readings twice, for the labelled rows and for the live ones.
TWICE = frozenset("risk_scores risk_scores_rows patient_risk".split())


def query(build: Callable[[Clinic], DataFrame]) -> Callable[[Clinic], DataFrame]:
    """Register `build` under its own name."""
    simple(build.__name__, build)
    return build


def simple(name: str, build: Callable[[Clinic], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: render(build(Clinic(spark, sf_dir, JOINED.get(name, ()), name in TWICE)))


# --- sources, bronze, quality -------------------------------------------------------
@query
def manifest_missing(c: Clinic) -> DataFrame:
    """Entities with no item type in the part table count as absent."""
    by_type = {t: e for e, t in ENTITY_TYPES.items() if e != "careplans"}
    names = F.create_map(*[F.lit(x) for pair in by_type.items() for x in pair])
    found = c.table("part").select(names[F.col("p_type")].alias("TABLE_NAME")).distinct()
    return quality.manifest_missing(c.spark, S.ENTITIES, found)


@query
def layer_report(c: Clinic) -> DataFrame:
    layers = {"staging": c.raw, "silver": c.silver, "gold": lambda e: c.gold[e]}
    others = {f"{e}_{layer}": of(e) for layer, of in layers.items() for e in S.ENTITIES}
    bronze = quality.layer_report({f"{e}_bronze": c.bronze(e) for e in S.ENTITIES}, S.BRONZE_METADATA)
    return bronze.unionByName(quality.layer_report(others))


def _bronze(c: Clinic, entities=S.ENTITIES) -> dict[str, DataFrame]:
    return {e: c.bronze(e) for e in entities}


simple("bronze_stamp", lambda c: c.bronze("encounters"))
for _entity in S.ENTITIES:
    if _entity != "encounters":
        simple(f"bronze_{_entity}", lambda c, e=_entity: c.bronze(e))
simple("null_profile", lambda c: quality.over_tables(_bronze(c), quality.null_profile))
simple("null_profile_pct", lambda c: quality.over_tables(_bronze(c), quality.null_profile_pct))
KEYED = ["patients", "encounters", "careplans"]
simple("key_uniqueness", lambda c: quality.over_tables(_bronze(c, KEYED), lambda df: quality.key_uniqueness(df, "ID")))


@query
def merged_profile(c: Clinic) -> DataFrame:
    """The profile of nine tables from the states of three loads each, and how near its sketch is."""
    parts = []
    for name, df in _bronze(c).items():
        load = F.pmod(F.xxhash64(df.columns[0]), F.lit(3))
        states = [quality.profile_state(df.filter(load == i), f"b{i}") for i in range(3)]
        merged = quality.merged_profile(reduce(DataFrame.unionByName, states))
        exact = df.agg(*[F.count_distinct(F.col(f"`{x}`")).alias(x) for x in df.columns])
        exact = exact.unpivot([], [F.col(f"`{x}`") for x in df.columns], "COLUMN_NAME", "EXACT")
        near = F.abs(F.col("DISTINCT_VALUES") - F.col("EXACT")) <= F.col("EXACT") * 0.05
        parts.append(
            merged.join(exact, "COLUMN_NAME").select(
                F.lit(name).alias("TABLE_NAME"), "COLUMN_NAME", "TOTAL", "MISSING", "EXACT", near.alias("NEAR")
            )
        )
    return reduce(DataFrame.unionByName, parts)


simple("duplicate_rows", lambda c: quality.over_tables(_bronze(c), quality.duplicate_rows))


@query
def interval_anomalies(c: Clinic) -> DataFrame:
    names = ["conditions", "medications", "allergies", "careplans"]
    return quality.interval_anomalies({e: c.bronze(e) for e in names})


# --- silver -----------------------------------------------------------------------------
simple("placeholder_fill", lambda c: silver.placeholder_fill(c.raw("patients")).select("ID", *S.IDENTITY_PLACEHOLDERS))
for _entity in S.ENTITIES:
    simple(f"silver_{_entity}", lambda c, e=_entity: c.silver(e))
simple("reading_seq", lambda c: silver.reading_seq(silver.split_value(c.bronze("observations"))))

# --- gold -------------------------------------------------------------------------------
simple("gold_patients", lambda c: c.patients)
simple("actual_value", lambda c: G.actual_value(silver.split_value(c.bronze("observations"))))
simple("observations_pivot", lambda c: G.observations_pivot(c.silver("observations")))
simple("reading_base", lambda c: G.reading_base(c.silver("observations")))
simple("gold_observations", lambda c: c.gold["observations"])
simple("conditions_per_encounter", lambda c: G.conditions_per_encounter(c.gold["conditions"]))
simple("medications_per_encounter", lambda c: G.medications_per_encounter(c.gold["medications"]))


@query
def obt_patient_encounters(c: Clinic) -> DataFrame:
    g = c.gold
    return G.obt_patient_encounters(
        g["encounters"], g["patients"], g["observations"], g["conditions"], g["medications"]
    )


# --- events ----------------------------------------------------------------------------
ENVELOPE = S.ENVELOPE_SCHEMA.names


def _messages(c: Clinic) -> DataFrame:
    """Envelopes as producers send them: one JSON text per row."""
    body = F.to_json(F.struct(*ENVELOPE), {"ignoreNullFields": "false"})
    return c.events.select(F.encode(body, "UTF-8").alias("value"))


def _identified(c: Clinic) -> DataFrame:
    return events.identify(c.events, c.now)


simple("event_type_filter", lambda c: events.event_type_filter(c.events).select("event_id", "event_type"))
simple("invalid_patient_events", lambda c: events.invalid_patient_events(c.events).select("event_id", "patient_id"))
simple("missing_required_fields", lambda c: events.missing_required_fields(c.events))
simple("observation_value_rule", lambda c: events.observation_value_rule(c.events))


@query
def event_defaults(c: Clinic) -> DataFrame:
    filled = events.fill_defaults(events.with_payload(events.event_type_filter(c.events)))
    return filled.select("event_id", "event_type", "P.*")


simple("event_identity", lambda c: _identified(c).select("event_id", "event_type", "EVENT_TS"))
simple("validation_report", lambda c: events.validation_report(c.events))


def _opened(sent: DataFrame) -> DataFrame:
    """The message key and the fields of its JSON text."""
    def at(path: str, name: str):
        return F.get_json_object("value", f"$.{path}").alias(name)

    head = [at(n, n) for n in ENVELOPE if n != "payload"]
    return sent.select("key", *head, *[at(f"payload.{f}", f) for f in S.PAYLOAD_FIELDS])


@query
def event_envelope_json(c: Clinic) -> DataFrame:
    return _opened(events.serialize_envelope(events.accepted(_identified(c))))


@query
def published_events(c: Clinic) -> DataFrame:
    """What publishing sends: the payload as given, with the defaults of its type."""
    good = events.merge_defaults(events.accepted(_identified(c)))
    return _opened(events.serialize_envelope(good))


@query
def envelope_roundtrip(c: Clinic) -> DataFrame:
    back = events.with_payload(events.parse_envelope(events.serialize_envelope(events.accepted(_identified(c)))))
    return back.select("event_id", "patient_id", "event_type", "event_timestamp", "P.CODE", "P.DESCRIPTION")


@query
def make_observation_events(c: Clinic) -> DataFrame:
    readings = c.silver("observations").select(
        "PATIENT_ID",
        "DESCRIPTION",
        F.date_format("OBSERVATION_DATE", "yyyy-MM-dd").alias("OBSERVATION_DATE"),
        "VALUE_NUMERIC",
        "VALUE_TEXT",
        "ENCOUNTER_ID",
    )
    made = events.with_payload(events.make_observation_events(readings, c.now))
    number = F.col("P.VALUE_NUMERIC").try_cast("double")
    return made.select(
        "patient_id", "event_type", "event_timestamp", "P.DESCRIPTION", "P.OBSERVATION_DATE", number.alias("VALUE_NUMERIC"),
        "P.VALUE_TEXT", "P.ENCOUNTER_ID",
    )


simple("event_quarantine", lambda c: events.quarantine(_identified(c)).select("event_id", "event_type", "REASON"))


@query
def stream_envelope(c: Clinic) -> DataFrame:
    return events.parse_envelope(_messages(c)).select(*ENVELOPE)


simple("stream_guard", lambda c: events.guard(events.parse_envelope(_messages(c))).select("event_id", "patient_id", "event_type"))
for _table in S.REALTIME_SCHEMAS:
    simple(_table.lower(), lambda c, t=_table: c.rt[t])


@query
def direct_append_events(c: Clinic) -> DataFrame:
    """All rows a direct append would add, typed in one pass, in their common columns."""
    common = ["EVENT_ID", "PATIENT_ID", "ENCOUNTER_ID", "DESCRIPTION", "EVENT_TS", "INGESTION_TS"]
    return events.parse_typed(events.ingest(c.events, c.now), c.now).select("TABLE_NAME", *common)


simple("route_counts", lambda c: events.route_counts(events.ingest(c.events, c.now)))


def _stored(c: Clinic, pending: bool) -> DataFrame:
    published = events.dedup_ids(_identified(c))
    return events.persisted_events(published, c.arrived, pending).select("event_id", "event_type", "TABLE_NAME")


simple("persisted_events", lambda c: _stored(c, False))
simple("pending_events", lambda c: _stored(c, True))


@query
def confirmed_events(c: Clinic) -> DataFrame:
    """Published events against arrivals up to a minute later, with the deadline of half a minute."""
    sent = events.ingest(c.events, c.now).select("event_id", "event_type", F.col("EVENT_TS").alias("PUBLISHED_TS"))
    late = F.length("payload") % 60
    stored = events.ingest(c.view("events_arrived"), c.now).select(
        "event_id", "event_type", F.timestamp_add("SECOND", late, "EVENT_TS").alias("STORED_TS")
    )
    return confirm.confirmations(sent, stored)


simple("dedup_events", lambda c: events.dedup_events(_identified(c)).select("event_id", "patient_id", "event_type", "event_timestamp"))
simple("events_per_window", lambda c: events.events_per_window(events.ingest(c.events, c.now)))

# --- patient state -----------------------------------------------------------------------
simple("patient_by_id", lambda c: state.patient_by_id(c.patients, "17"))
simple("patients_by_name", lambda c: state.patients_by_name(c.patients, "mer 00000000"))
simple("patients_by_name_index", lambda c: name_index.search(c.patients, name_index.postings(c.patients), "mer 00000000"))
simple("patient_info", lambda c: state.patient_info(c.patients))
simple("patient_status", lambda c: state.patient_status(c.patients))
simple("encounters_state", lambda c: state.encounters_state(c.gold, c.rt))
simple("conditions_state", lambda c: state.newest_first(state.conditions_state(c.gold, c.rt)))
simple("medications_state", lambda c: state.newest_first(state.medications_state(c.gold, c.rt)))
simple("allergies_state", lambda c: state.newest_first(state.allergies_state(c.gold, c.rt)))
simple("latest_obs_hist", lambda c: state.latest_obs_hist(c.gold))
simple("latest_obs_rt", lambda c: state.newest_first(state.latest_obs_rt(c.rt), "OBSERVATION_DATE"))
simple("observations_long", lambda c: state.observations_long(c.gold, c.rt))


def _requested(c: Clinic) -> DataFrame:
    """Patients named by events, shifted so that some do not exist."""
    shifted = (F.col("user_id") * 11).cast("string").alias("PATIENT_ID")
    return c.table("events").select(shifted).distinct()


simple("known_patients", lambda c: state.known_patients(_requested(c), c.patients))
simple("unknown_patients", lambda c: state.unknown_patients(_requested(c), c.patients))
simple("clinical_timeline", lambda c: state.clinical_timeline(c.gold, c.rt))


@query
def timeline_filtered(c: Clinic) -> DataFrame:
    kinds = ["ENCOUNTER", "OBSERVATION", "MEDICATION"]
    return state.timeline_filtered(state.timeline_rows(c.gold, c.rt), ["realtime"], kinds)


simple("timeline_day_breaks", lambda c: state.timeline_day_breaks(state.timeline_rows(c.gold, c.rt)))
simple("timeline_counts", lambda c: state.timeline_counts(state.timeline_rows(c.gold, c.rt)))
simple("patient_360", lambda c: state.patient_360(c.gold, c.rt, c.patients))

# --- features ----------------------------------------------------------------------------
simple("vital_averages", lambda c: features.vital_averages(c.gold, c.rt))
simple("reading_flags", lambda c: features.reading_flags(c.gold, c.rt))
simple("age_at_index", lambda c: features.age_at_index(c.patients, AS_OF))
simple("activity_counts", lambda c: features.activity_counts(c.gold, c.rt))
simple("patient_features", lambda c: c.features)


@query
def incremental_features(c: Clinic) -> DataFrame:
    """The history first, then the realtime facts as one batch, merged into its state."""
    no_rt = {t: df.limit(0) for t, df in c.rt.items()}
    no_gold = {e: c.gold[e].limit(0) for e in ("observations", "encounters", "conditions", "medications")}
    sums, codes, _ = feature_state.merge(None, feature_state.batch_sums(c.gold, no_rt), feature_state.batch_codes(c.gold, no_rt))
    sums, _, _ = feature_state.merge((sums, codes), feature_state.batch_sums(no_gold, c.rt), feature_state.batch_codes(no_gold, c.rt))
    return feature_state.feature_rows(c.patients, sums, AS_OF)


@query
def age_safety(c: Clinic) -> DataFrame:
    """Every second patient's age is given in days."""
    aged = features.age_at_index(c.patients, AS_OF)
    days = F.col("PATIENT_ID").cast("bigint") % 2 == 0
    mixed = F.when(days, F.col("AGE_AT_INDEX") * S.DAYS_PER_YEAR).otherwise(F.col("AGE_AT_INDEX"))
    return features.age_safety(aged.withColumn("AGE_AT_INDEX", mixed))


simple("feature_contract", lambda c: features.feature_contract(c.features.drop("AVG_GLUCOSE", "RACE")))
simple("features_ablated", lambda c: features.features_ablated(c.features))
simple("features_long", lambda c: features.features_long(c.features))

# --- cohorts -----------------------------------------------------------------------------
simple("index_dates", lambda c: c.dates)
simple("features_asof", lambda c: features.features_asof(c.dates, c.patients, c.gold, c.rt))
simple("features_buffered", lambda c: features.features_asof(c.dates, c.patients, c.gold, c.rt, buffer_days=180))
simple("matched_controls", lambda c: cohort.matched_controls(c.patients, c.dates, per_case=2))
simple("features_targets_long", lambda c: c.long)
simple("features_for_target", lambda c: cohort.features_for_target(c.labelled(["Stroke"]), "Stroke"))

# --- metrics -------------------------------------------------------------------------------
def _scores(c: Clinic) -> DataFrame:
    return c.view("scores")


def _split_scores(c: Clinic) -> DataFrame:
    return metrics.stratified_split(_scores(c), "ITEM_ID")


def _test_scores(c: Clinic) -> DataFrame:
    return _split_scores(c).filter(F.col("SPLIT") == "test")


def _best(c: Clinic) -> DataFrame:
    """Tuned on the test part, as models.evaluate does."""
    return metrics.optimal_threshold(metrics.pr_curve(_test_scores(c)))


simple("class_guard", lambda c: metrics.class_guard(_scores(c)))
simple("stratified_split", lambda c: _split_scores(c).select("ITEM_ID", "TARGET_NAME", "LABEL", "SPLIT"))
simple("class_weights", lambda c: metrics.class_weights(_split_scores(c).filter(F.col("SPLIT") == "train")))
simple("pr_curve", lambda c: metrics.pr_curve(_scores(c)))
simple("optimal_threshold", lambda c: _best(c))
simple("accuracy_at_threshold", lambda c: metrics.accuracy_at_threshold(_split_scores(c), _best(c)))
simple("roc_auc", lambda c: metrics.roc_auc(_split_scores(c), ["TARGET_NAME", "SPLIT"]))
simple("average_precision_lift", lambda c: metrics.average_precision_lift(_scores(c)))
simple("classification_report", lambda c: metrics.classification_report(_test_scores(c), _best(c)))


@query
def median_impute(c: Clinic) -> DataFrame:
    """Every target's rows, filled with the medians of its train part."""
    rows = models.prepare(c.long)
    train = rows.filter(F.col("SPLIT") == "train")
    numeric = list(S.NUMERIC_FEATURES)
    filled = models.median_impute(rows, models.feature_medians(train, numeric), numeric)
    return filled.select("PATIENT_ID", "TARGET_NAME", "INDEX_DATE", "LABEL", "SPLIT", *numeric)


@query
def onehot(c: Clinic) -> DataFrame:
    """The vocabulary of every target's train part, applied to all patients."""
    train = models.prepare(c.long).filter(F.col("SPLIT") == "train")
    return models.hot_features(features.patient_categories(c.patients), train, ["PATIENT_ID"])


# --- models ----------------------------------------------------------------------------------
#: Queries that fit, or wait for, all models of a folder.
TRAINING = frozenset(
    """train_score train_score_rows feature_importance importance_rows experiment_comparison comparison_rows
    risk_scores risk_scores_rows patient_risk trained_registry registry_keys""".split()
)
_GRIDS: dict[tuple, tuple[DataFrame, dict]] = {}


def _grid(c: Clinic) -> tuple[DataFrame, dict]:
    """The training rows and all models of this session for the files as they are now, trained once."""
    key = c.spark.sparkContext.applicationId, *c.files()
    if key not in _GRIDS:
        prepared = models.prepare(c.long)
        _GRIDS[key] = prepared, models.train_grid(prepared)
    return _GRIDS[key]


def _full(c: Clinic) -> dict:
    return {t: m for (t, f), m in _grid(c)[1].items() if f == models.FULL}


@query
def train_score(c: Clinic) -> DataFrame:
    return models.score_parts(_grid(c)[0], _full(c))


@query
def train_score_rows(c: Clinic) -> DataFrame:
    """The rows that were scored and whether the score is a probability."""
    p = F.col("PROBABILITY")
    return models.score_parts(_grid(c)[0], _full(c)).select(
        "PATIENT_ID", "TARGET_NAME", "INDEX_DATE", "LABEL", "SPLIT", ((p >= 0) & (p <= 1)).alias("IN_RANGE")
    )


@query
def feature_importance(c: Clinic) -> DataFrame:
    parts = [models.feature_importance(c.spark, m) for m in _grid(c)[1].values()]
    return reduce(DataFrame.unionByName, parts)


@query
def importance_rows(c: Clinic) -> DataFrame:
    """Per model how many features it has, whether their shares add up to one and none is negative."""
    parts = [models.feature_importance(c.spark, m, top=None) for m in _grid(c)[1].values()]
    share = F.sum("IMPORTANCE")
    return reduce(DataFrame.unionByName, parts).groupBy("TARGET_NAME", "FEATURE_SET").agg(
        F.count(F.lit(1)).alias("FEATURES"),
        ((share > 0.999999) & (share < 1.000001) & (F.min("IMPORTANCE") >= 0)).alias("SHARES"),
    )


@query
def experiment_comparison(c: Clinic) -> DataFrame:
    return models.experiment_comparison(*_grid(c))


METRICS = ["ROC_AUC", "PR_AUC", "OPTIMAL_F1", "OPTIMAL_THRESHOLD", "TRAIN_ACCURACY", "TEST_ACCURACY", "TRAIN_ROC_AUC"]


def _in_range(columns: list[str]):
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(m).between(0, 1), F.lit(False)) for m in columns])


@query
def comparison_rows(c: Clinic) -> DataFrame:
    """The models compared, and whether every metric is there and a share."""
    found = models.experiment_comparison(*_grid(c))
    return found.select("TARGET_NAME", "FEATURE_SET", "MODEL", _in_range(METRICS).alias("IN_RANGE"))


def _risk(c: Clinic) -> DataFrame:
    return models.risk_scores(c.features, _full(c))


simple("risk_scores", _risk)


@query
def risk_scores_rows(c: Clinic) -> DataFrame:
    p = F.col("PROBABILITY")
    return _risk(c).select("PATIENT_ID", "TARGET_NAME", F.coalesce((p >= 0) & (p <= 1), F.lit(False)).alias("IN_RANGE"))


@query
def patient_risk(c: Clinic) -> DataFrame:
    """One run for all patients: features, every model, tiers, and which models were there."""
    scores = _risk(c)
    return risk.risk_tiers(scores).join(risk.models_found_missing(scores), "PATIENT_ID")


def _trained(c: Clinic) -> DataFrame:
    targets = c.spark.createDataFrame([(t,) for t in [*S.TARGETS, "Untrained"]], "TARGET_NAME string")
    return models.trained_registry(*_grid(c), targets)


simple("trained_registry", _trained)


@query
def registry_keys(c: Clinic) -> DataFrame:
    """The registry of the fitted models without their figures."""
    found = _trained(c)
    figures = [x for x in found.columns if x in (*METRICS, "LIFT")]
    return found.select("*", _in_range(METRICS).alias("IN_RANGE")).drop(*figures)


@query
def model_registry(c: Clinic) -> DataFrame:
    """Every target, and one that nobody has trained."""
    scored = _scores(c)
    results = metrics.roc_auc(scored).join(metrics.average_precision_lift(scored), "TARGET_NAME")
    other = c.spark.sql("SELECT 'Untrained' AS TARGET_NAME")
    targets = scored.select("TARGET_NAME").distinct().unionByName(other)
    return models.model_registry(targets, models.registry_rows(results))


# --- risk display ------------------------------------------------------------------------------
simple("risk_tiers", lambda c: risk.risk_tiers(c.view("risk_before")))
simple("models_found_missing", lambda c: risk.models_found_missing(c.view("risk_before")))
simple("risk_delta", lambda c: risk.risk_delta(c.view("risk_before"), c.view("risk_after")))
