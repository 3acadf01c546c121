"""Raw tables cleaned, typed and keyed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.cleaning import (
    clean_string,
    parse_month,
    parse_timestamp,
    quoted,
    record_id,
    resolve_columns,
    safe_ratio,
)
from riskweave.operators.profiling import detect_pii

# Order statuses that make an order unreliable.
SUSPECT_STATUSES = ("CANCELED", "SUSPECTED_FRAUD")

# Source columns of the order extract by target name.
ORDER_COLUMNS = {
    "order_id": ["Order Id", "order_id"],
    "order_item_id": ["Order Item Id", "order_item_id"],
    "product_card_id": ["Product Card Id", "product_card_id"],
    "order_ts_text": ["order date (DateOrders)", "order_date"],
    "shipping_ts_text": ["shipping date (DateOrders)", "shipping_date"],
    "late_delivery_risk": ["Late_delivery_risk"],
    "days_real": ["Days for shipping (real)"],
    "days_scheduled": ["Days for shipment (scheduled)"],
    "order_status": ["Order Status"],
    "customer_segment": ["Customer Segment"],
    "quantity": ["Order Item Quantity"],
    "sales": ["Sales"],
    "order_item_total": ["Order Item Total"],
    "order_profit": ["Order Profit Per Order"],
}

# Typed columns of the directly copied tables; keys come first.
TABLE_SPECS: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "suppliers": (
        ("supplier_id",),
        {
            "supplier_id": "string",
            "supplier_name": "string",
            "parent_company": "string",
            "country": "string",
            "region": "string",
            "supplier_category": "string",
            "criticality_tier": "string",
            "annual_spend": "double",
            "single_source_flag": "boolean",
            "default_lead_time_days": "int",
        },
    ),
    "aliases": (
        ("supplier_id", "alias_name"),
        {"supplier_id": "string", "alias_name": "string", "alias_type": "string", "match_confidence": "double"},
    ),
    "sku_map": (
        ("supplier_id", "sku_id"),
        {
            "supplier_id": "string",
            "sku_id": "string",
            "dependency_percent": "double",
            "is_primary_supplier": "boolean",
            "alternate_supplier_available": "boolean",
            "standard_lead_time_days": "int",
            "origin_country": "string",
            "origin_port": "string",
            "destination_dc": "string",
            "transport_mode": "string",
            "minimum_order_quantity": "int",
        },
    ),
    "alternates": (
        ("sku_id", "primary_supplier_id", "alternate_supplier_id"),
        {
            "sku_id": "string",
            "primary_supplier_id": "string",
            "alternate_supplier_id": "string",
            "approved_flag": "boolean",
            "switching_cost_level": "string",
            "estimated_switch_days": "int",
            "capacity_available_pct": "double",
        },
    ),
    "routes": (
        ("route_id", "supplier_id"),
        {
            "route_id": "string",
            "supplier_id": "string",
            "origin_country": "string",
            "origin_port": "string",
            "destination_dc": "string",
            "transport_mode": "string",
            "carrier": "string",
            "standard_transit_days": "int",
            "risk_region": "string",
        },
    ),
    "crosswalk": (
        ("canonical_sku_id", "source_system", "source_product_id"),
        {
            "canonical_sku_id": "string",
            "source_system": "string",
            "source_product_id": "string",
            "source_product_name": "string",
            "source_category": "string",
            "source_department": "string",
            "confidence": "double",
            "mapping_rule": "string",
        },
    ),
}


def typed_table(df: DataFrame, name: str) -> DataFrame:
    """Texts cleaned, other columns leniently cast, surrogate key added."""
    keys, spec = TABLE_SPECS[name]
    cols = []
    for c, dtype in spec.items():
        if dtype == "string":
            cols.append(clean_string(F.col(c).cast("string")).alias(c))
        else:
            cols.append(F.col(c).try_cast(dtype).alias(c))
    out = df.select(*cols)
    return out.withColumn("record_id", record_id(*keys))


def build_scorecards(df: DataFrame) -> DataFrame:
    rates = ("fill_rate", "on_time_delivery_rate", "quality_issue_rate", "avg_lead_time_days", "lead_time_variance", "defect_rate")
    return df.select(
        clean_string(F.col("supplier_id")).alias("supplier_id"),
        parse_month(F.col("scorecard_month")).alias("scorecard_month"),
        *[F.col(c).try_cast("double").alias(c) for c in rates],
        F.col("is_deteriorating").try_cast("boolean").alias("is_deteriorating"),
    ).withColumn("record_id", record_id("supplier_id", "scorecard_month"))


def build_calendar(df: DataFrame) -> DataFrame:
    """Calendar dimension with date parts, weekend, event and benefit-day flags."""
    d = F.col("date").try_cast("date")
    events = {c: clean_string(F.col(c)) for c in ("event_name_1", "event_type_1", "event_name_2", "event_type_2")}
    count = events["event_name_1"].isNotNull().cast("int") + events["event_name_2"].isNotNull().cast("int")
    snaps = [F.col(c).try_cast("int") == 1 for c in ("snap_CA", "snap_TX", "snap_WI")]
    return df.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("calendar_date_id"),
        d.alias("calendar_date"),
        clean_string(F.col("d")).alias("day_id"),
        F.col("wm_yr_wk").try_cast("int").alias("wm_year_week"),
        clean_string(F.col("weekday")).alias("weekday_name"),
        F.col("wday").try_cast("int").alias("weekday_number"),
        F.col("year").try_cast("int").alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.col("month").try_cast("int").alias("month_number"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (count > 0).alias("is_event_day"),
        count.alias("event_count"),
        *[e.alias(n) for n, e in events.items()],
        *[s.alias(n) for n, s in zip(("snap_ca", "snap_tx", "snap_wi"), snaps, strict=True)],
        (snaps[0] | snaps[1] | snaps[2]).alias("is_snap_any_state"),
    )


def build_prices(df: DataFrame) -> DataFrame:
    """Weekly prices; the store id holds the state and the store number."""
    store = clean_string(F.col("store_id"))
    price = F.col("sell_price").try_cast("double")
    return df.select(
        store.alias("store_id"),
        F.split(store, "_").getItem(0).alias("state_id"),
        F.split(store, "_").getItem(1).try_cast("int").alias("store_number"),
        clean_string(F.col("item_id")).alias("item_id"),
        F.col("wm_yr_wk").try_cast("int").alias("wm_year_week"),
        price.alias("sell_price"),
        F.coalesce(price > 0, F.lit(False)).alias("is_valid_price"),
    ).withColumn("price_record_id", record_id("store_id", "item_id", "wm_year_week"))


def unpivot_numbered(df: DataFrame, ids: list[str], prefix: str, name: str, value: str) -> DataFrame:
    """Numbered columns ``prefix1 … prefixN`` to rows; map-only, no shuffle."""
    numbered = [c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]
    return df.unpivot(ids, numbered, name, value)


def join_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily sales with their calendar day. A calendar has one row per day of history, a few
    thousand rows at any data volume, so it is broadcast."""
    days = calendar.select(
        F.col("day_id").alias("d"), "calendar_date_id", "calendar_year", "month_number", "weekday_name",
        "is_weekend", "is_event_day", "event_count", "is_snap_any_state",
    )
    return sales.join(F.broadcast(days), "d", "left").withColumn(
        "sales_record_id", record_id("item_id", "store_id", "d")
    )


def build_inventory(df: DataFrame) -> DataFrame:
    """Inventory snapshot with clamped forecast, position, gap, coverage and price gap."""
    typed = df.select(
        F.col("Date").try_cast("date").alias("inventory_date"),
        clean_string(quoted("Store ID")).alias("store_id"),
        clean_string(quoted("Product ID")).alias("product_id"),
        clean_string(F.col("Category")).alias("category"),
        clean_string(F.col("Region")).alias("region"),
        quoted("Inventory Level").try_cast("int").alias("inventory_level"),
        quoted("Units Sold").try_cast("int").alias("units_sold"),
        quoted("Units Ordered").try_cast("int").alias("units_ordered"),
        quoted("Demand Forecast").try_cast("double").alias("demand_forecast_raw"),
        F.col("Price").try_cast("double").alias("price"),
        F.col("Discount").try_cast("double").alias("discount"),
        clean_string(quoted("Weather Condition")).alias("weather_condition"),
        quoted("Holiday/Promotion").try_cast("int").alias("holiday_promotion_flag"),
        quoted("Competitor Pricing").try_cast("double").alias("competitor_pricing"),
        clean_string(F.col("Seasonality")).alias("seasonality"),
    )
    raw = F.col("demand_forecast_raw")
    typed = typed.withColumns(
        {
            "demand_forecast": F.when(raw < 0, F.lit(0.0)).otherwise(raw),
            "demand_forecast_was_negative": F.coalesce(raw < 0, F.lit(False)),
            "inventory_position": F.coalesce("inventory_level", F.lit(0)) + F.coalesce("units_ordered", F.lit(0)),
        }
    )
    return typed.withColumn(
        "stockout_gap_units", F.greatest(F.col("demand_forecast") - F.col("inventory_position"), F.lit(0.0))
    ).withColumns(
        {
            "is_stockout_risk": F.col("stockout_gap_units") > 0,
            "inventory_coverage_ratio": safe_ratio(F.col("inventory_position"), F.col("demand_forecast")),
            "sell_through_rate": safe_ratio(F.col("units_sold"), F.col("inventory_level")),
            "price_vs_competitor": F.col("price") - F.col("competitor_pricing"),
            "inventory_record_id": record_id("inventory_date", "store_id", "product_id"),
        }
    )


def build_orders(df: DataFrame) -> DataFrame:
    """Order lines with parsed dates, delay flags and margin; personal columns never selected."""
    x = resolve_columns(df.drop(*detect_pii(df.columns)), ORDER_COLUMNS)
    x = x.withColumns(
        {
            "order_timestamp": parse_timestamp(clean_string(F.col("order_ts_text"))),
            "shipping_timestamp": parse_timestamp(clean_string(F.col("shipping_ts_text"))),
            "order_status": clean_string(F.col("order_status")),
            "customer_segment": clean_string(F.col("customer_segment")),
        }
    ).drop("order_ts_text", "shipping_ts_text")
    order_date = F.to_date("order_timestamp")
    delay = F.col("days_real").try_cast("int") - F.col("days_scheduled").try_cast("int")
    return x.withColumns(
        {
            "order_date": order_date,
            "shipping_date": F.to_date("shipping_timestamp"),
            "order_date_id": F.date_format(order_date, "yyyyMMdd").try_cast("int"),
            "order_year": F.year(order_date),
            "order_month": F.month(order_date),
            "shipping_delay_days": delay,
            "is_late_delivery": F.col("late_delivery_risk").try_cast("int") == 1,
            "is_delayed_beyond_schedule": delay > 0,
            "is_suspect_order": F.upper("order_status").isin(*SUSPECT_STATUSES),
            "profit_margin": F.when(F.col("sales") != 0, F.col("order_profit") / F.col("sales")),
            "order_record_id": record_id("order_id", "order_item_id", "product_card_id"),
        }
    )


def build_purchase_orders(df: DataFrame) -> DataFrame:
    """Planned and actual lead time, delay, late flag and fill rate of each PO line."""
    order, expected, actual = (F.col(c).try_cast("date") for c in ("order_date", "expected_delivery_date", "actual_delivery_date"))
    ordered, received = F.col("quantity_ordered").try_cast("int"), F.col("quantity_received").try_cast("int")
    return df.withColumns(
        {
            "order_date": order,
            "planned_lead_time_days": F.datediff(expected, order),
            "actual_lead_time_days": F.datediff(actual, order),
            "delivery_delay_days": F.datediff(actual, expected),
            "is_po_late": F.coalesce(F.datediff(actual, expected) > 0, F.lit(False)),
            "po_fill_rate": safe_ratio(received, ordered),
            "po_record_id": record_id("po_id", "po_line_id"),
        }
    )


def split_evidence(df: DataFrame, preview: int = 200) -> tuple[DataFrame, DataFrame]:
    """Events without the raw payload, and one evidence row per payload with preview and size."""
    keys = ["api_run_id", "payload_hash"]
    events = df.drop("raw_payload_json").withColumn("evidence_document_id", record_id(*keys))
    evidence = (
        df.groupBy(*keys)
        .agg(F.max("source_name").alias("source_name"), F.max("raw_payload_json").alias("_raw"))
        .select(
            record_id(*keys).alias("evidence_document_id"),
            *keys,
            "source_name",
            F.substring("_raw", 1, preview).alias("raw_payload_preview"),
            F.length("_raw").alias("raw_payload_size_chars"),
            F.lit("pointer_to_raw_table").alias("evidence_storage_mode"),
        )
    )
    return events, evidence
