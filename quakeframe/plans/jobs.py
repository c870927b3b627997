"""Dataset jobs: one lazy plan from sources to rows that the sinks write."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.columns import event_id, haversine_km, hours_to_event
from quakeframe.operators import dsp, encode, evaluate, groundmotion, mining, sequence, signal, split
from quakeframe.sources.catalog import with_station
from quakeframe.session import materialize
from quakeframe.sources.sinks import window_name

Encoder = Callable[[DataFrame], DataFrame]
SPECTROGRAM = {"n_fft": 256, "hop": None, "top_db": 80.0, "normalize": "station"}
LEAST_TARGETS = 5


def encoder(kind: str | Encoder, n: int = 64, spectrogram: dict | None = None) -> Encoder:
    """What adds img, seq and aux to windows (z, n, e and, where known, mu_*, sigma_* and profile) by the name of a dataset's kind.

    angles, spectrogram: img alone. dual, spec_dual: with seq. _aux: with the two mean scalars, _aux_v2: with six, one a
    component and kind. Any function from windows to windows is an encoder, too.
    """
    if callable(kind):
        return kind
    image, _, aux = kind.partition("_aux")
    image, dual = ("spectrogram" if "spec" in image else "angles"), "dual" in image
    if kind not in KINDS:
        raise ValueError(f"kind is one of {sorted(KINDS)} or a function")
    steps: list[Encoder] = [partial(encode.aux_scalars, per_component=aux == "_v2")] if "_aux" in kind else []
    steps += [encode.sequences] if dual else []
    steps += [partial(encode.angle_images, n=n) if image == "angles" else partial(encode.spectrogram_images, **(SPECTROGRAM | (spectrogram or {})))]

    def run(windows: DataFrame) -> DataFrame:
        for step in steps:
            windows = step(windows)
        return windows

    return run


KINDS = frozenset(f"{image}{aux}" for image in ("angles", "dual", "spec_dual") for aux in ("", "_aux", "_aux_v2")) | {"spectrogram"}


def forecast_dataset(events: DataFrame, threshold: float = 4.5, horizon_days: float = 30.0, size: int = 64, stride: int = 8) -> DataFrame:
    """Dense windows of zoned events with an embargoed chronological split."""
    return split.chronological(sequence.dense_windows(events, size, stride, threshold, horizon_days), embargo_days=horizon_days)


def tercile_dataset(events: DataFrame, targets: DataFrame, major: float = 6.0, one_out: bool = False, least_targets: int = LEAST_TARGETS) -> DataFrame:
    """Windows with classes of the time to the next target; one_out puts all rows in one split for leave-one-event-out folds, of least_targets events at least."""
    windows = sequence.tercile_windows(events, targets, major=major)
    if one_out:
        if (n := windows.select("target_time").distinct().count()) < least_targets:
            raise ValueError(f"leave-one-event-out takes {least_targets} target events, not {n}")
        return split.tercile_classes(windows.withColumn("split", F.lit("all")))
    placed = split.chronological(windows, target="target_time")
    return split.tercile_classes(placed, fit_on=F.col("split") == "train").where("split <> 'dropped'")


def station_windows(traces: DataFrame, seconds: float = 60.0, overlap: float = 0.5, fs: float = 100.0, low: float = 1.0, high: float = 45.0, most_gaps: float = 0.05, chosen: DataFrame | None = None) -> DataFrame:
    """Cleaned three-component windows (file_path, station_key, w_idx, fs, z, n, e) of station records at fs.

    Of traces with gap_mask, windows go in which more than most_gaps of any component is masked; indexes are kept.
    chosen (file_path, station_key, n_windows, quota, ...) keeps its records' windows alone, with a quota below n_windows so many
    evenly spaced ones, and adds its further columns; windows that it drops are never cut or cleaned.
    """
    records = encode.stations(traces, ["file_path", "station_key"]).where(F.col("fs") == fs)
    more = [c for c in chosen.columns if c not in ("file_path", "station_key", "n_windows", "quota")] if chosen is not None else []
    if chosen is not None:
        records = records.join(chosen, ["file_path", "station_key"])
    n = F.least(*(F.size(c) for c in "zne"))
    size, step, tolerance = signal.window_shape(fs, seconds, overlap)
    rows = records.withColumn("__n", n).where(F.col("__n") >= size - tolerance)
    rows = rows.withColumn("w_idx", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil((F.col("__n") - size) / step), F.lit(0)).cast("int"))))
    rows = rows.where(F.col("__n") - F.col("w_idx") * step >= size - tolerance)
    if chosen is not None:
        rows = rows.where(F.col("quota").isNull() | split.evenly_spaced(F.col("w_idx"), F.col("n_windows"), F.col("quota")))
    here = lambda c: F.slice(c, F.col("w_idx") * step + 1, F.least(F.lit(size), F.col("__n") - F.col("w_idx") * step))
    if "mask_z" in rows.columns:
        gaps = F.greatest(*(F.size(F.filter(here(f"mask_{c}"), lambda x: x)) for c in "zne")) / F.lit(float(size))
        rows = rows.where(gaps <= most_gaps)
    padded = lambda c: F.concat(here(c), F.array_repeat(F.lit(0.0), F.lit(size) - F.size(here(c))))
    rows = rows.select("file_path", "station_key", "w_idx", "fs", *more, *(padded(c).alias(c) for c in "zne"))
    for c in "zne":
        rows = dsp.clean(rows, fs, low, high, c)
    return rows


def header_counts(traces: DataFrame, fs: float, seconds: float, overlap: float) -> DataFrame:
    """file_path, station_key, n_windows. npts is read where there is such a column, so that samples needn't be."""
    npts = F.col("npts") if "npts" in traces.columns else F.size("samples")
    lengths = traces.select("file_path", "station_key", npts.alias("__npts")).groupBy("file_path", "station_key").agg(F.min("__npts").alias("__npts"))
    return lengths.select("file_path", "station_key", signal.window_count(F.col("__npts"), fs, seconds, overlap).cast("long").alias("n_windows")).where("n_windows > 0")


def quota_windows(windows: DataFrame, chosen: DataFrame) -> DataFrame:
    """windows of chosen (file_path, station_key, n_windows, quota, ...): with a quota below n_windows, so many evenly spaced ones."""
    joined = windows.join(chosen, ["file_path", "station_key"])
    kept = F.col("quota").isNull() | split.evenly_spaced(F.col("w_idx"), F.col("n_windows"), F.col("quota"))
    return joined.where(kept).drop("quota", "n_windows")


def negative_whitelist(scored: DataFrame, quotas: DataFrame, band: tuple[float, float] = (0.75, 0.99), like: DataFrame | None = None) -> DataFrame:
    """(file_path, station_key, w_idx) of the mined class's windows to keep: of each split as many as the quotas of its files,
    ranked over all stations, from a loud band or with the scores of like (split, score). Splits without a quota have none.

    scored: split, file_path, station_key, w_idx, score. quotas: split, quota.
    """
    keys = ["file_path", "station_key", "w_idx"]
    wanted = quotas.groupBy("split").agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("__want")).where("__want > 0")
    own = scored.join(wanted, "split")
    loud = lambda df: mining.band_pick(df, ["split"], "score", keys, F.col("__want"), band)
    if like is None:
        return loud(own).select(*keys)
    matched = own.join(like.select("split").distinct(), "split", "left_semi")
    rest = own.join(like.select("split").distinct(), "split", "left_anti")  # splits without positives
    return mining.matched_pick(matched, like, "score", keys, F.col("__want"), by=("split",)).select(*keys).unionByName(loud(rest).select(*keys))


def with_baselines(rows: DataFrame, baselines: DataFrame | None, profiles: DataFrame | None) -> DataFrame:
    if baselines is not None:
        rows = rows.join(baselines, "station_key", "left")
    else:
        rows = rows.withColumns({f"{k}_{c}": F.lit(None).cast("double") for k in ("mu", "sigma") for c in "zne"})
    return encode.with_profiles(rows, profiles) if profiles is not None else rows


def detection_dataset(
    traces: DataFrame,
    classes: DataFrame,
    kind: str | Encoder = "angles",
    cap: int | None = None,
    fs: float = 100.0,
    seconds: float = 60.0,
    overlap: float = 0.5,
    n: int = 64,
    baselines: DataFrame | None = None,
    max_balance: bool = False,
    profiles: DataFrame | None = None,
    spectrogram: dict | None = None,
    mined: str | None = None,
    matched: str | None = None,
    band: tuple[float, float] = (0.75, 0.99),
) -> DataFrame:
    """Encoded windows of two classes, stations in one split each.

    classes has file_path and class_name. Counts, caps and splits come from
    metadata alone, and only rows that they keep are windowed and encoded. mined names the
    class whose windows are chosen by loudness over all stations instead of evenly from each file;
    matched the class whose loudness they follow.
    """
    counts = header_counts(traces, fs, seconds, overlap).join(classes, "file_path")
    counts = split.cap_quota(counts, "station_key", "n_windows", cap, ["file_path"]) if cap else counts.withColumn("quota", F.lit(None).cast("long"))
    counts = counts.withColumn("kept", F.coalesce("quota", "n_windows"))
    names = [r[0] for r in counts.select("class_name").distinct().orderBy("class_name").collect()]  # the classes of the job
    keys = counts.groupBy("station_key").agg(*(F.sum(F.when(F.col("class_name") == c, F.col("kept")).otherwise(0)).alias(f"w{k}") for k, c in enumerate(names)))
    weights = [f"w{k}" for k in range(len(names))]
    placed = split.deficit_splits(keys.withColumn("w", sum(F.col(w) for w in weights)), "station_key", "w") if max_balance else split.fill_splits(keys, "station_key", weights)
    chosen = counts.join(placed, "station_key").where("kept > 0")
    cells = chosen.select("file_path", "station_key", "class_name", "split", "quota", "n_windows")

    def cleaned(own: DataFrame) -> DataFrame:
        records = traces.join(own.select("file_path", "station_key").distinct(), ["file_path", "station_key"], "left_semi")
        return with_baselines(station_windows(records, seconds, overlap, fs, chosen=own), baselines, profiles)

    if not mined:
        rows = cleaned(cells)
    else:  # loudness is of all windows of the two classes: these are cleaned once and written
        loud = F.col("class_name").isin(*[c for c in (mined, matched) if c])
        quota = cells.where(loud).select("file_path", "station_key", "n_windows", "quota")
        every = materialize(cleaned(cells.where(loud).withColumn("quota", F.lit(None).cast("long"))), "windows")
        score = encode.amplitude_score(*(F.col(c) for c in "zne"), *(F.col(f"sigma_{c}") for c in "zne")).alias("score")
        scored = every.select("split", "class_name", "file_path", "station_key", "w_idx", score)
        like = scored.where(F.col("class_name") == matched).select("split", "score") if matched else None
        quotas = chosen.where(F.col("class_name") == mined).select("split", F.col("kept").alias("quota"))
        picked = negative_whitelist(scored.where(F.col("class_name") == mined).drop("class_name"), quotas, band, like)
        rows = every.where(F.col("class_name") == mined).join(picked, ["file_path", "station_key", "w_idx"], "left_semi")
        rows = rows.unionByName(quota_windows(every.where(F.col("class_name") != mined), quota)).unionByName(cleaned(cells.where(~loud)))
    return encoder(kind, n, spectrogram)(rows).withColumn("filename", window_name(F.col("file_path"), F.col("station_key"), F.col("w_idx"), "parquet"))


def risk_dataset(
    traces: DataFrame,
    noise: DataFrame,
    events: DataFrame,
    stations: DataFrame,
    kind: str | Encoder = "spectrogram",
    baselines: DataFrame | None = None,
    threshold: float = 4.0,
    ratio: float = 4.0,
    least_log_snr: float | None = -3.0,
    cap: int | None = None,
    fs: float = 100.0,
    seconds: float = 3.0,
    overlap: float = 0.5,
    n: int = 64,
    profiles: DataFrame | None = None,
    spectrogram: dict | None = None,
) -> DataFrame:
    """Encoded windows of three classes: 00_noise, 01_low_risk and, from magnitude threshold on, 02_high_risk; stations in one split each.

    Noise and low risk are cut, file by file in shuffled order, to ratio times the split's high-risk windows; there is no cut in a
    split without any. Windows quieter than least_log_snr go, those without a baseline stay. Files of unknown events go.
    """
    known = events.select("event_id", "magnitude", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    counted = lambda t: header_counts(t, fs, seconds, overlap).withColumn("event_id", event_id(F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)))
    risk = F.when(F.col("magnitude") >= threshold, "02_high_risk").otherwise("01_low_risk")
    quakes = counted(traces).join(known, "event_id").withColumn("risk_class", risk)
    quiet = counted(noise).withColumn("event_id", F.lit(None).cast("string")).withColumn("risk_class", F.lit("00_noise"))
    entries = quakes.unionByName(quiet, allowMissingColumns=True)
    placed = split.deficit_splits(entries.groupBy("station_key").agg(F.sum("n_windows").alias("w")), "station_key", "w")
    entries = entries.join(placed, "station_key").withColumn("__group", F.concat_ws("|", "split", "risk_class"))
    high = entries.groupBy("split").agg(F.coalesce(F.sum(F.when(F.col("risk_class") == "02_high_risk", F.col("n_windows"))), F.lit(0)).alias("__high"))
    keys = ["file_path", "station_key"]
    shuffled = sequence.running(entries.withColumn("__h", split.hashed_order(*keys, seed=49)), ["__h", *keys], {"__prior": F.col("n_windows")}, ["__group"])
    most = F.when((F.col("risk_class") != "02_high_risk") & (F.col("__high") > 0), F.rint(F.col("__high") * ratio))
    kept = shuffled.join(high, "split").where(F.coalesce(F.col("__prior") < most, F.lit(True))).drop("__h", "__prior", "__high", "__group")
    kept = kept.withColumn("source", F.when(F.col("risk_class") == "00_noise", "noise").otherwise("event"))
    if cap:
        kept = split.cap_quota(kept.withColumn("__from", F.concat_ws("|", "source", "station_key")), "__from", "n_windows", cap, ["file_path"], seed=53).drop("__from")
    else:
        kept = kept.withColumn("quota", F.lit(None).cast("long"))
    parts = []
    for table, source in ((traces, "event"), (noise, "noise")):
        own = kept.where((F.col("source") == source) & (F.col("quota").isNull() | (F.col("quota") > 0))).drop("source")
        parts.append(station_windows(table.join(own.select(*keys).distinct(), keys, "left_semi"), seconds, overlap, fs, chosen=own))
    rows = with_baselines(parts[0].unionByName(parts[1]), baselines, profiles)
    rows = encode.aux_scalars(rows, missing=None).withColumn("log_snr", F.col("aux")[0]).drop("aux")
    if least_log_snr is not None:
        rows = rows.where(F.col("log_snr").isNull() | (F.col("log_snr") >= least_log_snr))
    rows = _with_distance(rows, stations)
    return encoder(kind, n, spectrogram)(rows).withColumn("filename", window_name(F.col("file_path"), F.col("station_key"), F.col("w_idx"), "parquet"))


def _with_distance(rows: DataFrame, stations: DataFrame) -> DataFrame:
    """Adds distance_km from (__lat, __lon), which go, to the station by NET.STA or the bare name."""
    parts = F.split("station_key", r"\.")
    located = with_station(rows.withColumns({"network": parts[0], "station": parts[1]}), stations)
    distance = haversine_km(F.col("__lat"), F.col("__lon"), F.col("latitude"), F.col("longitude"))
    return located.withColumn("distance_km", distance).drop("__lat", "__lon", "network", "station", "latitude", "longitude")


def event_dataset(windows: DataFrame, events: DataFrame, stations: DataFrame) -> DataFrame:
    """Windows of event files with magnitude and distance, events in one split each; files of unknown events go."""
    stem = F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    named = windows.withColumn("event_id", event_id(stem)).where(F.col("event_id").isNotNull())
    joined = named.join(events.select("event_id", "magnitude", F.col("lat").alias("__lat"), F.col("lon").alias("__lon")), "event_id")
    located = _with_distance(joined, stations)
    keys = located.groupBy("event_id").agg(F.count(F.lit(1)).alias("w"))
    return located.join(split.deficit_splits(keys, "event_id", "w"), "event_id")


def evaluate_onsets(windows: DataFrame, seconds: float, fs: float, positive: str = "earthquake") -> tuple[DataFrame, DataFrame]:
    """AUC, and the best threshold with its rates, of the largest energy ratio of each window's vertical component."""
    short, long = signal.onset_parameters(seconds)
    ratio = signal.onset(signal.detrend(F.col("z")), max(1, int(short * fs)), max(2, int(long * fs)), float("inf"))
    scored = windows.select((F.col("class_name") == positive).cast("int").alias("label"), ratio["top_ratio"].alias("score"))
    return evaluate.roc_auc(scored), evaluate.youden(scored)


def picked(traces: DataFrame, by: list[str], short: float = 1.0, long: float = 10.0, on: float = 3.5) -> DataFrame:
    """by, arrival (null without a trigger) and best_ratio: the first trigger of each station record, vertical first, then by channel.

    Records of fewer than three traces have no row.
    """
    full = traces.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n >= 3").drop("n")
    rates = [r[0] for r in traces.select("sampling_rate").distinct().collect()]  # a few rates
    made = []
    for fs in rates:
        found = signal.onset(signal.detrend(F.col("samples")), max(1, int(short * fs)), max(2, int(long * fs)), on)
        own = traces.where(F.col("sampling_rate") == fs).join(full, by, "left_semi")
        made.append(own.select(*by, "component", F.coalesce("channel", "component").alias("channel") if "channel" in traces.columns else F.col("component").alias("channel"), found.alias("__o")))
    if not made:
        return full.select(*by, F.lit(None).cast("int").alias("arrival"), F.lit(None).cast("double").alias("best_ratio")).limit(0)
    rows = made[0]
    for other in made[1:]:
        rows = rows.unionByName(other)
    return groundmotion.pick(rows.select(*by, "component", "channel", F.col("__o.onset").alias("onset"), F.col("__o.top_ratio").alias("top_ratio")), by)


def anchored_windows(traces: DataFrame, seconds: list[float], before: float = 0.2, short: float = 1.0, long: float = 10.0, on: float = 3.5) -> DataFrame:
    """Traces cut around each station record's arrival, for each length: traces' columns with samples cut, target (the dataset's
    name), arrival and, in place of starttime, the cut's own. A record stays for a length only if all its traces can be cut.

    traces: file_path, station_key, component, sampling_rate, samples and, if known, channel and starttime.
    """
    by = ["file_path", "station_key"]
    arrivals = picked(traces, by, short, long, on).where(F.col("arrival").isNotNull()).select(*by, "arrival")
    lengths = F.array(*(F.struct(F.lit(f"window_post_{s:g}s_anchored").alias("target"), F.lit(float(s)).alias("__s")) for s in seconds))
    rows = traces.join(arrivals, by).select("*", F.inline(lengths))
    size = (F.col("sampling_rate") * F.col("__s")).cast("int")
    start = (F.col("arrival") - F.lit(before) * size).cast("int")
    at = F.when((start >= 0) & (F.size("samples") >= size), F.least(start, F.size("samples") - size))
    rows = rows.withColumns({"__at": at, "__size": size})
    whole = rows.groupBy(*by, "target").agg(F.count(F.when(F.col("__at").isNull(), 1)).alias("__lost")).where("__lost = 0").select(*by, "target")
    rows = rows.join(whole, [*by, "target"], "left_semi").withColumn("samples", F.slice("samples", F.col("__at") + 1, F.col("__size")))
    if "starttime" in traces.columns:
        moved = F.unix_micros(F.col("starttime").cast("timestamp")) + F.rint(F.col("__at") / F.col("sampling_rate") * 1_000_000).cast("long")
        rows = rows.withColumn("starttime", F.timestamp_micros(moved).cast("timestamp_ntz"))
    return rows.drop("__at", "__size", "__s")


def ground_motion_records(traces: DataFrame, responses: DataFrame, short: float = 1.0, long: float = 10.0, on: float = 3.5, corners: tuple[float, float, float, float] | None = (0.05, 0.1, 40.0, 45.0), water_level: float = 60.0) -> DataFrame:
    """What ground_motion_dataset takes, of raw counts: a row a station record with an arrival, its counts (raw_z, raw_n, raw_e) and
    their ground motion by the response in force at its start (vel_ and acc_), cut to the shortest component; response_ok only if
    all three components have a response.

    traces: file_path, station_key, network, station, channel, component, starttime, sampling_rate, samples and, if known, gap_mask.
    """
    by = ["file_path", "station_key"]
    arrivals = picked(traces, by, short, long, on).where(F.col("arrival").isNotNull())
    moved = groundmotion.without_response(traces, responses, corners=corners, water_level=water_level)
    rows = encode.stations(moved, by, ("vel", "acc", "response_ok", "sens_mismatch")).join(arrivals, by)
    n = F.least(*(F.size(c) for c in "zne"))
    rows = rows.withColumn("__n", n).where("__n > 0")
    fit = lambda c: F.slice(c, F.lit(1), F.col("__n"))
    masked = sum(F.size(F.filter(fit(f"mask_{c}"), lambda v: v)) for c in "zne") / (3.0 * F.col("__n")) if "mask_z" in rows.columns else F.lit(0.0)
    stem = F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return rows.select(
        *by,
        event_id(stem).alias("event_id"),
        "fs",
        "arrival",
        F.col("best_ratio").alias("max_cft"),
        masked.alias("n_masked_frac"),
        (F.col("response_ok_z") & F.col("response_ok_n") & F.col("response_ok_e")).alias("response_ok"),
        F.greatest(*(f"sens_mismatch_{c}" for c in "zne")).alias("sens_mismatch"),
        *(fit(c).alias(f"raw_{c}") for c in "zne"),
        *(fit(f"{k}_{c}").alias(f"{k}_{c}") for k in ("vel", "acc") for c in "zne"),
    )


def ground_motion_dataset(records: DataFrame, events: DataFrame, stations: DataFrame, target: str = "vel") -> tuple[DataFrame, DataFrame]:
    """Rows with the input window of target (vel or acc; three arrays in cm/s or cm/s2) and peak labels, events in one split each;
    and the records that have no usable response or room for the input, with the reason.

    records: file_path, station_key, event_id, what groundmotion.ground_motion takes, response_ok and sens_mismatch.
    """
    if target not in ("vel", "acc"):
        raise ValueError("target is vel or acc")
    known = events.select("event_id", "magnitude", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    labelled = records.join(known, "event_id")
    usable = F.coalesce(F.col("response_ok"), F.lit(False))
    first, end, _ = groundmotion.window_bounds(F.col("arrival"), F.size("vel_z"), F.col("fs"))
    reason = F.when(~usable, "no usable response").when(first.isNull(), "no room for the input")
    dropped = labelled.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("file_path", "station_key", "event_id", "reason")
    splits = split.deficit_splits(labelled.groupBy("event_id").agg(F.count(F.lit(1)).alias("w")), "event_id", "w")
    own = labelled.where(usable).withColumns({"__first": first, "__last": end})
    window = F.array(*(F.transform(F.slice(f"{target}_{c}", F.col("first_sample") + 1, F.col("input_samples")), lambda v: (v * 100).cast("float")) for c in "zne"))
    rows = groundmotion.ground_motion(own.withColumns({"first_sample": F.col("__first"), "input_samples": F.col("__last") - F.col("__first")}).drop("__first", "__last"))
    rows = rows.withColumn("seq", window).drop("first_sample", "input_samples", *(f"{k}_{c}" for k in ("raw", "vel", "acc") for c in "zne"))
    logs = {f"log_{a}_{b}": F.when(F.col(c) > 0, F.log10(c)) for a, u in (("pga", "gal"), ("pgv", "cms")) for b in ("fwd", "full") for c in (f"{a}_{u}_{b}",)}
    rows = _with_distance(rows.join(splits, "event_id"), stations).withColumns({**logs, "arrival_s": F.col("arrival") / F.col("fs")})
    stem = F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return rows.withColumn("filename", F.concat(stem, F.lit("_"), F.col("station_key"), F.lit(".parquet"))), dropped


def raw_windows(manifest: DataFrame, traces: DataFrame, seconds: float, overlap: float) -> DataFrame:
    """manifest's rows with z, n and e, the raw samples that they were made of: cut at w_idx, padded with zeros at the record's end.

    manifest: file_path, station_key, fs and w_idx or, without it, filename. Rows past the record's end or of unknown records go.
    """
    index = F.col("w_idx") if "w_idx" in manifest.columns else F.regexp_extract("filename", r"_win(\d+)", 1)
    asked = manifest.withColumn("__w", index.cast("string")).where("__w <> ''").withColumn("__w", F.col("__w").cast("int"))
    records = encode.stations(traces, ["file_path", "station_key"]).select("file_path", "station_key", *(F.col(c).alias(f"__{c}") for c in "zne"))
    rows = asked.join(records, ["file_path", "station_key"])
    size = (F.col("fs") * F.lit(seconds)).cast("int")
    step = (size * F.lit(1.0 - overlap)).cast("int")
    rows = rows.withColumns({"__size": size, "__start": F.col("__w") * step, "__length": F.least(*(F.size(f"__{c}") for c in "zne"))}).where("__start < __length")
    part = lambda c: F.slice(f"__{c}", F.col("__start") + 1, F.least(F.col("__size"), F.col("__length") - F.col("__start")))
    padded = lambda c: F.concat(part(c), F.array_repeat(F.lit(0.0), F.col("__size") - F.size(part(c))))
    return rows.withColumns({c: padded(c) for c in "zne"}).drop("__w", "__size", "__start", "__length", *(f"__{c}" for c in "zne"))


def evaluate_manifest(manifest: DataFrame, traces: DataFrame, seconds: float, overlap: float, fs: float = 100.0, on_split: str = "test", positive: str = "earthquake") -> tuple[DataFrame, DataFrame]:
    """evaluate_onsets of a detection manifest's rows of one split, from the raw windows."""
    rows = manifest.where(F.col("split") == on_split).withColumn("fs", F.coalesce(F.col("fs").cast("double"), F.lit(fs)))
    return evaluate_onsets(raw_windows(rows, traces, seconds, overlap), seconds, fs, positive)


def cleaned_diffs(traces: DataFrame, fs: float, seconds: float, by: list[str], low: float = 1.0, high: float = 45.0, n: int = 64, origin: str | None = None) -> DataFrame:
    """by, w_idx, rms_diff and image_diff of each window and the one just before it; the whole trace is cleaned before it is cut, without overlap.

    With origin, the column of an event's time, also hours_to_event of the window (traces then have starttime).
    """
    masked = "gap_mask" in traces.columns
    windows = signal.sliding_windows(dsp.clean(traces, fs, low, high), fs, seconds, 0.0, mask="gap_mask" if masked else None)
    both = signal.consecutive_diff(windows, by).join(signal.image_diff(windows, by, n), [*by, "w_idx"])
    if origin is None:
        return both
    starts = traces.select(*by, "starttime", F.col(origin).alias("__origin")).dropDuplicates(by)
    hours = hours_to_event(F.col("starttime"), F.col("w_idx"), int(fs * seconds), fs, F.col("__origin"))
    return both.join(starts, by).withColumn("hours_to_event", hours).drop("starttime", "__origin")


def pooled_diffs(diffs: DataFrame, by: list[str], windows: str = "n_windows", values: tuple[str, ...] = ("rms_diff", "image_diff"), least: int = 3) -> DataFrame:
    """The mean of each value over a group's pooled pairs, of groups with so many windows together; a row of diffs counts its windows once a trace."""
    out = diffs.groupBy(*by).agg(F.sum(windows).alias(windows), *(F.avg(v).alias(v) for v in values))
    return out.where((F.col(windows) >= least) & F.col(values[0]).isNotNull())


def paired_offsets(diffs: DataFrame, offsets: tuple[str, str] = ("3h", "6h"), keys: tuple[str, ...] = ("event_id", "station_key"), values: tuple[str, ...] = ("raw_diff", "ram_diff")) -> DataFrame:
    """keys with both offsets: each value at either side and the difference, first less second."""
    a, b = (diffs.where(F.col("offset") == o).select(*keys, *(F.col(v).alias(f"{v}_{s}") for v in values)) for o, s in zip(offsets, "ab", strict=True))
    return a.join(b, list(keys)).withColumns({f"{v}_change": F.col(f"{v}_a") - F.col(f"{v}_b") for v in values})


def first_files(files: DataFrame, n: int, path: str = "file_path") -> DataFrame:
    """The first n files by path."""
    return files.orderBy(path).limit(n)


def noise_batches(plan: DataFrame, events: DataFrame, seconds: int = 300, buffer: int = 300) -> DataFrame:
    """Planned noise windows that no event contaminates."""
    return mining.veto(plan, events, "start", seconds, buffer)
