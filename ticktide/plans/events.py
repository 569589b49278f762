"""Envelopes to typed events, and catalogue records to canonical markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Aliases of lifecycle messages by venue (lower case), marker keys of a game frame.
LIFECYCLE = {
    ("polymarket", "CREATED"): ("newmarketevent", "new_market", "market_created"), ("polymarket", "RESOLVED"): ("marketresolved", "market_resolved", "resolved"),
    ("limitless", "CREATED"): ("marketcreated", "market_created"), ("limitless", "RESOLVED"): ("marketresolved", "market_resolved"),
}
GAME_KEYS = ("gameId", "metadataGameId", "leagueAbbreviation", "homeTeam", "awayTeam", "eventState")


def _get(path: str, payload: Column) -> Column:
    return F.get_json_object(payload, path)


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _text(value: Column) -> Column:
    """Text of a JSON value; null, JSON null and empty text are one."""
    return F.nullif(_as(value, "string"), F.lit(""))


def _exact(value: Column, kind: str = "decimal(24,8)") -> Column:
    """A finite, non-negative number, given as text or number, exactly; else null."""
    x = _as(value, "string").try_cast(kind)
    return F.when((x >= 0) & (F.schema_of_variant(value) != "BOOLEAN"), x)


def _is(value: Column, what: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(what)), F.lit(False))


def ladder(levels: Column) -> Column:
    """Exact levels of a JSON array; null (no book) if it is none or any level is not two finite, non-negative numbers."""
    items = _as(levels, "array<variant>")
    pair = lambda x: F.struct(_exact(F.try_variant_get(x, "$.price", "variant"), "decimal(12,8)").alias("price"), _exact(F.try_variant_get(x, "$.size", "variant")).alias("size"))
    exact = F.transform(items, pair)
    return F.when(_is(levels, "ARRAY") & ~F.exists(exact, lambda x: x["price"].isNull() | x["size"].isNull()), exact)


def _first_text(*values: Column) -> Column:
    return F.coalesce(*map(_text, values))


def normalize(tape: DataFrame) -> DataFrame:
    """One row per typed event: the envelope's columns, event_index, event_kind and the typed columns.

    A payload is parsed once, to a variant whose fields are then a map. Arrays of messages
    and of price changes are exploded; event_index is message * 1e6 + change for changes,
    else the message. The stream decides first (process, snapshot, reference), then the venue.
    What no rule understands becomes kind raw with its name in ``note``; nothing is dropped.
    """
    stream, venue = F.col("stream"), F.col("venue")
    whole = F.try_parse_json(F.col("raw_payload"))
    df = tape.withColumn("_whole", whole)
    process = stream == "process"
    many = ~process & _is(F.col("_whole"), "ARRAY")
    df = df.select("*", F.posexplode_outer(F.when(many, _as(F.col("_whole"), "array<variant>")).otherwise(F.array("_whole"))).alias("_m", "_v"))
    df = df.withColumn("_object", _is(F.col("_v"), "OBJECT")).withColumn("_f", F.when(F.col("_object"), _as(F.col("_v"), "map<string,variant>")))
    f, has = (lambda n: F.col("_f")[n]), (lambda n: F.coalesce(F.map_contains_key("_f", F.lit(n)), F.lit(False)))
    poly, limitless = F.col("_object") & (venue == "polymarket"), F.col("_object") & (venue == "limitless")
    name = F.coalesce(F.when(limitless | process, _text(f("event"))).otherwise(_first_text(f("event_type"), f("event"))), F.lit(""))
    inner = F.when(_is(f("payload"), "OBJECT"), _as(f("payload"), "map<string,variant>"))
    data = F.when(_is(f("data"), "OBJECT"), _as(f("data"), "map<string,variant>"))
    state = F.when(_is(f("eventState"), "OBJECT"), _as(f("eventState"), "map<string,variant>"))
    df = df.withColumns({"_name": name, "_inner": inner, "_data": data, "_state": state})
    single = F.col("_object") & ~many
    snapshot, reference = single & (stream == "public_snapshot"), single & (stream == "reference_event")
    general = ~process & ~snapshot & ~reference
    game = reference & (F.size(F.array_intersect(F.map_keys("_f"), F.array(*map(F.lit, GAME_KEYS)))) > 0)

    changes = F.when(general & poly & (F.col("_name") == "price_change") & _is(f("price_changes"), "ARRAY"), _as(f("price_changes"), "array<variant>"))
    # a frame of changes that is empty gives no event, as it names none
    df = df.withColumn("_changes", changes).where(F.col("_changes").isNull() | (F.size("_changes") > 0))
    df = df.select("*", F.posexplode_outer("_changes").alias("_c", "_change"))
    ch = lambda n: F.try_variant_get(F.col("_change"), f"$.{n}", "variant")
    change_ok = F.col("_c").isNotNull() & _as(ch("asset_id"), "string").isNotNull() & _as(ch("side"), "string").isNotNull() & _exact(ch("price")).isNotNull() & _exact(ch("size")).isNotNull()

    order_book = F.when(_is(F.col("_data")["orderbook"], "OBJECT"), _as(F.col("_data")["orderbook"], "map<string,variant>"))
    update = general & limitless & (F.col("_name") == "orderbookUpdate")
    book = snapshot | (general & poly & (F.col("_name") == "book"))
    side = lambda n: ladder(F.when(update, order_book[n]).when(book, f(n)))
    asset = F.when(update, _as(F.col("_data")["marketSlug"], "string")).when(snapshot, F.coalesce(_text(f("asset_id")), _as(f("asset"), "string"))).otherwise(_as(f("asset_id"), "string"))
    df = df.withColumns({"_bids": side("bids"), "_asks": side("asks"), "_asset": asset})
    full = (book | update) & F.col("_bids").isNotNull() & F.col("_asks").isNotNull() & F.col("_asset").isNotNull()
    trade = general & poly & (F.col("_name") == "last_trade_price") & F.col("_asset").isNotNull() & _as(f("side"), "string").isNotNull() & _exact(f("price")).isNotNull() & _exact(f("size")).isNotNull()
    life = F.lit(None).cast("string")
    for (of, what), names in LIFECYCLE.items():
        life = F.when(general & F.col("_object") & (venue == of) & F.lower("_name").isin(*names), what).otherwise(life)
    known = F.coalesce(F.when(~_is_null(f("gameId")), F.lit("gameId")), F.when(~_is_null(f("metadataGameId")), F.lit("metadataGameId")))
    game_id = F.when(known == "gameId", _as(f("gameId"), "string")).otherwise(_as(f("metadataGameId"), "string"))
    kind = (
        F.when(process & (F.col("_name") == "connection_opened"), "connection_opened").when(process & (F.col("_name") == "connection_closed"), "connection_closed")
        .when(process & (F.col("_name") == "target_metadata_changed") & _text(f("to_metadata_digest")).isNotNull(), "metadata_changed")
        .when(game, F.when(known.isNotNull(), "game_state").otherwise("raw")).when(reference, "reference_tick").when(full, "full_book")
        .when(F.col("_c").isNotNull(), F.when(change_ok, "book_delta").otherwise("raw")).when(trade, "trade").when(life.isNotNull(), "market_lifecycle").otherwise("raw")
    )
    df = df.withColumn("_kind", kind)
    is_kind = lambda *k: F.col("_kind").isin(*k)
    prefer = lambda n: F.when(F.coalesce(F.map_contains_key("_state", F.lit(n)), F.lit(False)), F.col("_state")[n]).otherwise(f(n))
    boolean = lambda v: F.when(_is(v, "BOOLEAN"), _as(v, "boolean"))
    scope = F.when(_is(f("clock_scope"), "OBJECT"), _as(f("clock_scope"), "map<string,variant>"))
    tick = F.when(F.coalesce(F.map_contains_key("_inner", F.lit("full_accuracy_value")), F.lit(False)), F.col("_inner")["full_accuracy_value"]).otherwise(F.col("_inner")["value"])
    game_columns = F.struct(
        game_id.alias("game_id"), known.alias("game_id_field"), _text(f("leagueAbbreviation")).alias("league"), _text(f("homeTeam")).alias("home"), _text(f("awayTeam")).alias("away"), _text(f("status")).alias("status"),
        _text(prefer("score")).alias("score"), _text(prefer("period")).alias("period"), _text(prefer("elapsed")).alias("elapsed"), boolean(prefer("live")).alias("live"), boolean(prefer("ended")).alias("ended"),
        _text(f("finishedTimestamp")).alias("finished_timestamp"), _text(F.col("_state")["updatedAt"]).alias("state_updated_at"), _text(F.col("_state")["createdAt"]).alias("state_created_at"),
    )
    slug = F.coalesce(*(_text(F.col("_data")[n]) for n in ("marketSlug", "slug", "id")))
    market = (
        F.when(update & full, _text(F.col("_data")["marketSlug"])).when(is_kind("market_lifecycle") & limitless, slug)
        .when(is_kind("market_lifecycle"), _first_text(f("market"), f("condition_id"))).when(is_kind("full_book", "book_delta", "trade"), _text(f("market")))
    )
    note = F.when(F.col("_whole").isNull(), "text").when(F.col("_c").isNotNull(), "unparseable_price_change").when(game, "game_state_without_identifier").when(snapshot, "snapshot")
    note = note.when(~process & ~F.col("_object"), "not_an_object").when(F.col("_name") != "", F.col("_name")).otherwise(F.when(process, "control").otherwise("unknown"))
    index = F.when(F.col("_c").isNotNull(), F.col("_m") * 1_000_000 + F.col("_c")).otherwise(F.col("_m"))
    return df.select(
        *tape.columns, index.cast("long").alias("event_index"), F.col("_kind").alias("event_kind"),
        F.when(is_kind("book_delta"), _as(ch("asset_id"), "string")).when(is_kind("full_book", "trade"), F.col("_asset")).when(is_kind("reference_tick"), _as(F.col("_inner")["symbol"], "string")).alias("asset_id"), market.alias("market"),
        F.when(is_kind("book_delta"), F.upper(_as(ch("side"), "string"))).when(is_kind("trade"), F.upper(_as(f("side"), "string"))).alias("side"),
        F.when(is_kind("book_delta"), _exact(ch("price"))).when(is_kind("trade"), _exact(f("price"))).when(is_kind("reference_tick"), _exact(tick)).alias("price"),
        F.when(is_kind("book_delta"), _exact(ch("size"))).when(is_kind("trade"), _exact(f("size"))).alias("size"),
        F.when(is_kind("book_delta"), _text(ch("hash"))).when(is_kind("full_book") & ~update, _text(f("hash"))).alias("state_hash"),
        F.when(update & full, _as(F.col("_data")["timestamp"], "string")).when(is_kind("reference_tick"), F.coalesce(_as(F.col("_inner")["timestamp"], "string"), _as(f("timestamp"), "string")))
        .when(is_kind("full_book", "book_delta", "trade"), _as(f("timestamp"), "string")).alias("source_time"),
        F.when(full, F.col("_bids")).alias("bids"), F.when(full, F.col("_asks")).alias("asks"), F.when(full, snapshot | update).alias("independent"), F.when(update & full, _as(F.col("_data")["version"], "string")).alias("source_version"),
        F.when(is_kind("market_lifecycle"), life).alias("lifecycle"), F.when(is_kind("game_state"), game_columns).alias("game"),
        F.when(is_kind("connection_opened"), _text(f("target_metadata_digest"))).when(is_kind("metadata_changed"), _text(f("to_metadata_digest"))).alias("metadata_digest"),
        F.when(is_kind("connection_opened"), F.transform(_as(f("asset_ids"), "array<variant>"), lambda x: _as(x, "string"))).alias("opened_assets"),
        F.when(is_kind("connection_opened"), boolean(f("delivers_deltas"))).alias("delivers_deltas"), F.when(is_kind("connection_opened"), _text(f("target_digest"))).alias("target_digest"),
        F.when(is_kind("connection_opened"), F.try_variant_get(f("fsync_interval_seconds"), "$", "double")).alias("fsync_interval_seconds"),
        F.when(is_kind("connection_opened"), _text(scope["scope_id"])).alias("clock_scope_id"), F.when(is_kind("connection_opened"), boolean(scope["comparable_across_processes"])).alias("clock_comparable"),
        F.when(trade, _text(f("transaction_hash"))).alias("transaction_id"), F.when(is_kind("raw"), note).alias("note"),
    )


def _is_null(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def derived_cursor(payload: Column, venue: Column) -> Column:
    """struct(type, first, last, previous_last) for a tape that lacks cursors."""
    seq, version, at = _get("$.seq", payload).try_cast("long"), _get("$.data.version", payload).try_cast("long"), _get("$.timestamp", payload).try_cast("long")
    make = lambda t, a, b, c: F.struct(F.lit(t).alias("type"), a.alias("first"), b.alias("last"), c.alias("previous_last"))
    none = F.lit(None).cast("long")
    return F.when((venue == "kalshi") & seq.isNotNull(), make("update_range", seq, seq, seq - 1)).when(version.isNotNull(), make("snapshot", none, version, none)).when(at.isNotNull(), make("snapshot_time", none, at, none)).otherwise(make("unsequenced", none, none, none))


def projected(record: Column, paths: list[str]) -> Column:
    """Map of the consumed paths that are present, as JSON text; null values kept, absent paths omitted."""
    variant = F.try_parse_json(record)
    entries = F.array(*(F.struct(F.lit(p).alias("key"), F.to_json(F.try_variant_get(variant, f"$.{p}", "variant")).alias("value")) for p in sorted(paths)))
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def projection_hash(record: Column, paths: list[str]) -> Column:
    """SHA-256 of the projection: changes of other fields leave it alone."""
    m = projected(record, paths)
    pairs = F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.sha2(F.array_join(pairs, "\n").cast("binary"), 256)


def instruments(targets: DataFrame) -> DataFrame:
    """(venue, asset_id, outcome_index, outcome, size_scale, minimum, fee columns) from target records.

    ``targets`` (venue, asset_id, record). Token lists may be JSON inside a string.
    """
    r = F.col("record")
    tokens = F.from_json(F.coalesce(_get("$.clobTokenIds", r), F.lit("[]")), "array<string>")
    outcomes = F.from_json(F.coalesce(_get("$.outcomes", r), F.lit("[]")), "array<string>")
    at = F.array_position(tokens, F.col("asset_id"))
    return targets.select(
        "venue", "asset_id", F.when(at > 0, at - 1).alias("outcome_index"), F.when((at > 0) & (at <= F.size(outcomes)), F.try_element_at(outcomes, at.cast("int"))).alias("outcome"),
        F.pow(F.lit(10.0), F.coalesce(_get("$.decimals", r).try_cast("int"), F.lit(0))).alias("size_scale"), _get("$.orderMinSize", r).try_cast("double").alias("minimum"), *fee_terms(r),
    )


def fee_terms(record: Column) -> list[Column]:
    """fee_rate, fee_exponent, fee_complete: disabled fees are a complete model; a schedule needs both terms."""
    off = _get("$.feesEnabled", record) == "false"
    rate, exponent = _get("$.feeSchedule.rate", record).try_cast("double"), _get("$.feeSchedule.exponent", record).try_cast("double")
    both = rate.isNotNull() & exponent.isNotNull()
    return [F.when(off, 0.0).when(both, rate).alias("fee_rate"), F.when(off, 1.0).when(both, exponent).alias("fee_exponent"), (F.coalesce(off, F.lit(False)) | both).alias("fee_complete")]


def settled_outcome(prices: Column, outcomes: Column) -> Column:
    """The single outcome at 1.0; FIFTY_FIFTY if all are 0.5; else null."""
    ones = F.filter(F.arrays_zip(prices.alias("p"), outcomes.alias("o")), lambda z: z["p"] == 1.0)
    return F.when(F.size(ones) == 1, F.element_at(ones, 1)["o"]).when((F.size(prices) > 0) & F.forall(prices, lambda p: p == 0.5), "FIFTY_FIFTY")


def pair_by_vote(candidates: DataFrame, key: str, pair: str) -> DataFrame:
    """The pair named most often per key, ties to the lesser; ``disputed`` if several were named."""
    votes = candidates.groupBy(key, pair).agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(key).agg(F.min_by(pair, F.struct(-F.col("_n"), F.col(pair))).alias(pair), (F.count(F.lit(1)) > 1).alias("disputed"))


def first_agreed_instant(fields: dict[str, Column]) -> Column:
    """struct(instant, field, disagreeing): the first field, in order, whose values agree on one instant."""
    agreed = [F.when(F.size(F.array_distinct(v)) == 1, F.struct(F.element_at(v, 1).alias("instant"), F.lit(n).alias("field"))) for n, v in fields.items()]
    odd = F.array_compact(F.array(*(F.when(F.size(F.array_distinct(v)) > 1, F.lit(n)) for n, v in fields.items())))
    best = F.coalesce(*agreed)
    return F.struct(best["instant"].alias("instant"), best["field"].alias("field"), odd.alias("disagreeing"))


#: Depth to which nested JSON is walked for fee records.
DEPTH = 8


def nested_fee_records(documents: DataFrame, payload: str) -> DataFrame:
    """(condition_id, identity, created_at, updated_at): every object, at any depth, that names a condition and fees.

    A document is parsed once; each level holds the members of the objects and arrays of
    the level before. Nesting beyond DEPTH is an error, nothing is skipped. ``identity`` is the
    fee terms alone: times of creation and update are left out.
    """
    none = F.array().cast("array<variant>")
    members = lambda v: F.when(_is(v, "OBJECT"), F.map_values(_as(v, "map<string,variant>"))).when(_is(v, "ARRAY"), _as(v, "array<variant>")).otherwise(none)
    df = documents.select(F.array(F.try_parse_json(F.col(payload))).alias("_l0"))
    for i in range(DEPTH):
        df = df.withColumn(f"_l{i + 1}", F.flatten(F.transform(f"_l{i}", members)))
    deeper = F.exists(f"_l{DEPTH}", lambda v: _is(v, "OBJECT") | _is(v, "ARRAY"))
    checked = F.when(deeper, F.raise_error(F.lit("fee records are nested too deep")).cast("array<variant>")).otherwise(none)
    df = df.select(F.explode(F.concat(*(f"_l{i}" for i in range(DEPTH)), checked)).alias("_v")).where(_is(F.col("_v"), "OBJECT"))
    df = df.select(_as(F.col("_v"), "map<string,variant>").alias("_f"))
    f = lambda n: F.col("_f")[n]
    df = df.where(_text(f("conditionId")).isNotNull() & (F.map_contains_key("_f", F.lit("feesEnabled")) | F.map_contains_key("_f", F.lit("feeSchedule"))))
    schedule = lambda n: F.try_variant_get(f("feeSchedule"), f"$.{n}", "double")
    terms = F.struct(
        F.coalesce(F.when(_is(f("feesEnabled"), "BOOLEAN"), _as(f("feesEnabled"), "boolean")), F.lit(False)).alias("fees_enabled"), _text(f("feeType")).alias("fee_type"), schedule("rate").alias("rate"),
        F.coalesce(schedule("exponent"), F.lit(1.0)).alias("exponent"), _is(f("feeSchedule"), "OBJECT").alias("has_schedule"), _text(f("version")).alias("version"),
    )
    return df.select(_text(f("conditionId")).alias("condition_id"), terms.alias("identity"), _text(f("createdAt")).alias("created_at"), _text(f("updatedAt")).alias("updated_at"))


def fee_records(conditions: DataFrame, records: DataFrame) -> DataFrame:
    """One row a condition: its fee terms and status over all its records.

    ``missing``: no record; ``conflict``: records that differ in their terms;
    ``missing_schedule``: fees are on without a schedule; else ``found``, effective from
    the first record. Fees that are off are a rate of 0.
    """
    out = records.groupBy("condition_id").agg(F.count_distinct("identity").alias("_n"), F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"), F.min("identity").alias("_i"))
    out = conditions.select("condition_id").distinct().join(out, "condition_id", "left")
    status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "conflict").when(F.col("_i.fees_enabled") & ~F.col("_i.has_schedule"), "missing_schedule").otherwise("found")
    good = status == "found"
    on = good & F.col("_i.fees_enabled")
    return out.select(
        "condition_id", status.alias("status"), F.when(good, F.coalesce("_i.fee_type", F.lit("no_fee"))).alias("fee_type"),
        F.when(on, F.col("_i.rate")).when(good, 0.0).alias("rate"), F.when(on, F.col("_i.exponent")).when(good, 1.0).alias("exponent"),
        F.when(good, F.col("created_at")).alias("created_at"), F.when(good, F.col("updated_at")).alias("updated_at"),
    )


def fee_timeline(base: DataFrame, changes: DataFrame, key: str, effective: str, multiplier: str) -> DataFrame:
    """Base schedule and dated changes as validity intervals; ``conflict`` marks two values at one instant."""
    rows = base.select(key, F.lit(-1).cast("long").alias(effective), multiplier).unionByName(changes.select(key, effective, multiplier))
    one = rows.groupBy(key, effective).agg(F.min(multiplier).alias(multiplier), F.coalesce(F.min(multiplier) < F.max(multiplier), F.lit(False)).alias("conflict"))  # no row a value
    return one.withColumn("until", F.lead(effective).over(Window.partitionBy(key).orderBy(effective)))


def traded_usd(contracts: Column, price: Column) -> Column:
    """Contracts times last price, null if unknown or negative, six decimals."""
    return F.when((contracts >= 0) & (price >= 0), F.bround(contracts * price, 6))


def integrity_violations(events: DataFrame, markets: DataFrame) -> DataFrame:
    """(constraint, id) rows: repeated ids, dangling references, volumes that aren't finite, empty subscriptions."""
    dup = lambda df, c, n: df.groupBy(c).count().where("count > 1").select(F.lit(n).alias("constraint"), F.col(c).cast("string").alias("id"))
    dangling = markets.join(events.select("event_id"), "event_id", "left_anti").select(F.lit("dangling_event").alias("constraint"), F.col("market_id").cast("string").alias("id"))
    volume = markets.where(F.isnan("volume") | (F.abs("volume") == float("inf"))).select(F.lit("volume_not_finite").alias("constraint"), F.col("market_id").cast("string").alias("id"))
    empty = markets.where((F.size("subscription_ids") == 0) | (F.size(F.array_distinct("subscription_ids")) < F.size("subscription_ids"))).select(F.lit("subscriptions").alias("constraint"), F.col("market_id").cast("string").alias("id"))
    return dup(events, "event_id", "event_repeated").unionByName(dup(markets, "market_id", "market_repeated")).unionByName(dangling).unionByName(volume).unionByName(empty)
