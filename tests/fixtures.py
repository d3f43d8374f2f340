"""Small staging tables and change messages, invented for the tests."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

from tallyhouse.sources.schemas import BY_NAME

EMPLOYEES = [
    (1, "Ana", "Reed", "Rep", 2), (2, "Bo", "Stone", "Head", None), (3, "Cy", "Marsh", "Rep", 2),
    (4, "Di", "Field", "Rep", 2), (5, "Ed", "Brook", "Lead", 2), (6, "Flo", "Wood", "Rep", 5),
    (7, "Gus", "Hill", "Rep", 5), (8, "Hal", "Lake", None, 2), (9, "Ivy", "Glen", "Rep", 5),
]
SHIPPERS = [(1, "Swift", "100"), (2, "Parcel", None), (3, "Freightline", "  300 ")]
REGIONS = [(1, "East"), (2, "West  "), (3, "North"), (4, "South")]
TERRITORIES = [("T01", "Harbor", 1), ("T02", "Mill ", 2), ("T03", "Pine", 3), ("T04", "Gate", 4), ("T05", "Dune", 9)]
BRIDGE = [(1, "T01"), (2, "T02"), (3, "T03"), (5, "T04"), (9, "T05")]


def _rows(spark, table, rows):
    """Rows given as dicts; other columns are NULL."""
    spec = BY_NAME[table]
    return spark.createDataFrame([tuple(r.get(c) for c in spec.schema.names) for r in rows], spec.schema)


def staging(spark) -> dict:
    day = datetime
    tables = {
        "employees": [dict(zip(("employee_id", "first_name", "last_name", "title", "reports_to"), e)) for e in EMPLOYEES],
        "shippers": [dict(zip(("shipper_id", "company_name", "phone"), s)) for s in SHIPPERS],
        "regions": [dict(zip(("region_id", "region_description"), r)) for r in REGIONS],
        "territories": [dict(zip(("territory_id", "territory_description", "region_id"), t)) for t in TERRITORIES],
        "employee_territories": [dict(zip(("employee_id", "territory_id"), b)) for b in BRIDGE],
        "customers": [
            {"customer_id": "C1", "company_name": " Alpha ", "country": "Peru", "region": "", "city": "Lima"},
            {"customer_id": "C2", "company_name": "Beta", "country": "Peru", "region": "  ", "city": "Lima"},
            {"customer_id": "C3", "company_name": "Gamma", "country": "Peru", "region": None, "city": "Lima"},
            {"customer_id": "C4", "company_name": "Delta", "country": "Chile", "region": "N", "city": "Arica"},
        ],
        "suppliers": [{"supplier_id": 1, "company_name": "Maker", "country": "Chile", "region": "N", "city": "Arica"}],
        "categories": [{"category_id": 1, "category_name": "Tools"}],
        "products": [
            {"product_id": 1, "product_name": "Axe", "supplier_id": 1, "category_id": 1, "unit_price": Decimal("10"), "units_in_stock": 3, "reorder_level": 5, "discontinued": False},
            {"product_id": 2, "product_name": "Saw", "supplier_id": 7, "category_id": 9, "unit_price": None, "units_in_stock": 8, "reorder_level": 2, "discontinued": True},
        ],
        "orders": [
            {"order_id": 1, "customer_id": "C1", "employee_id": 1, "order_date": day(2024, 1, 1), "required_date": day(2024, 1, 9), "shipped_date": day(2024, 1, 4), "ship_via": 1, "freight": Decimal("1.5"), "ship_name": " A ", "ship_country": "Peru", "ship_city": "Lima"},
            {"order_id": 2, "customer_id": "C2", "employee_id": None, "order_date": day(2024, 1, 2), "required_date": day(2024, 1, 5), "shipped_date": day(2024, 1, 8), "ship_via": 2, "ship_country": "Peru", "ship_region": " ", "ship_city": "Lima"},
            {"order_id": 3, "customer_id": "ZZ", "employee_id": 5, "order_date": day(2024, 2, 1), "required_date": day(2024, 2, 9), "shipped_date": None, "ship_via": None, "ship_country": "Chile", "ship_region": "N", "ship_city": "Arica"},
        ],
        "order_details": [
            {"order_id": 1, "product_id": 1, "unit_price": Decimal("10"), "quantity": 5, "discount": 0.0},
            {"order_id": 1, "product_id": 2, "unit_price": Decimal("20"), "quantity": 1, "discount": 0.1},
            {"order_id": 2, "product_id": 1, "unit_price": Decimal("10"), "quantity": 10, "discount": 0.15},
            {"order_id": 3, "product_id": 1, "unit_price": Decimal("10"), "quantity": 2, "discount": 0.25},
        ],
    }
    return {name: _rows(spark, name, rows) for name, rows in tables.items()}


def lsn(number: int) -> str:
    return f"0x{number:020X}"


def event(number: int, instance: str, operation: int, key: dict, payload: dict | None = None, **changes) -> dict:
    body = {
        "capture_instance": instance, "operation_code": operation, "event_time": "2024-03-01T10:00:00Z",
        "business_key": key, "payload": payload or dict(key),
        "metadata": {"start_lsn": lsn(number), "seqval": lsn(number)},
    }
    body.update(changes)
    return {k: v for k, v in body.items() if v != "DROP"}


def order_event(number, operation, order_id, **payload):
    return event(number, "dbo_Orders", operation, {"OrderID": order_id}, {"OrderID": order_id, **payload})


def line_event(number, operation, order_id, product_id, price="10", quantity=1, discount=0.0):
    key = {"OrderID": order_id, "ProductID": product_id}
    return event(number, "dbo_Order_Details", operation, key, {**key, "UnitPrice": price, "Quantity": quantity, "Discount": discount})


def messages(spark, *bodies):
    """Stream messages at consecutive offsets; a body may be an event, raw text or None."""
    from tallyhouse.streaming.sources import MESSAGE_SCHEMA

    rows = []
    for offset, body in enumerate(bodies):
        text = json.dumps(body) if isinstance(body, dict) else body
        value = text if text is None or isinstance(text, bytes) else text.encode()
        rows.append((str(offset), None if value is None else bytearray(value), "t", 0, offset, datetime(2024, 3, 1)))
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
