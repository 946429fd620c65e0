"""The message contract: event kinds, their topics and their payload fields."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Payload field names and types, in wire order. All are nullable.
ORDER_FIELDS = {
    "event_type": "string",
    "event_id": "string",
    "timestamp": "string",
    "user_id": "string",
    "session_id": "string",
    "order_id": "string",
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "quantity": "int",
    "unit_price": "double",
    "discount": "double",
    "subtotal": "double",
    "total_amount": "double",
    "currency": "string",
    "status": "string",
    "city": "string",
    "device": "string",
}

CLICK_FIELDS = {
    "event_type": "string",
    "event_id": "string",
    "timestamp": "string",
    "user_id": "string",
    "session_id": "string",
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "page": "string",
    "device": "string",
    "os": "string",
    "browser": "string",
    "city": "string",
    "time_on_page": "int",
}

PAYMENT_FIELDS = {
    "event_type": "string",
    "event_id": "string",
    "timestamp": "string",
    "user_id": "string",
    "order_id": "string",
    "payment_id": "string",
    "amount": "double",
    "currency": "string",
    "payment_method": "string",
    "status": "string",
    "failure_reason": "string",
    "city": "string",
    "device": "string",
}

# A message as a topic-based source delivers it.
MESSAGE_FIELDS = {
    "key": "binary",
    "value": "binary",
    "topic": "string",
    "timestamp": "timestamp",
}

# Where in its topic a message was, if the log says so.
POSITION_FIELDS = {"partition": "int", "offset": "bigint"}

PARTITION_FIELDS = {"date": "date", "hour": "int"}


def ddl(fields: Mapping[str, str]) -> str:
    """Schema text that ``from_json`` and the readers accept."""
    return ", ".join(f"`{name}` {dtype}" for name, dtype in fields.items())


@dataclass(frozen=True, eq=False)
class EventKind:
    """One type of event: what its payload calls it, where it travels, what it holds."""

    name: str
    topic: str
    fields: Mapping[str, str]
    # The one column the lake table adds for this kind only.
    derived: Mapping[str, str]

    @property
    def table(self) -> str:
        """Lake table, also the name of its checkpoint."""
        return f"{self.name}s"

    @property
    def lake_fields(self) -> dict[str, str]:
        """Columns of the lake table as read back: partition columns come last."""
        kept = {name: dtype for name, dtype in self.fields.items() if name != "timestamp"}
        stamps = dict.fromkeys(("kafka_timestamp", "event_ts", "ingest_ts"), "timestamp")
        return {**kept, **stamps, "is_weekend": "boolean", **self.derived, **PARTITION_FIELDS}


# Kind names and topics.
ORDER = EventKind("order", "ecommerce.orders", ORDER_FIELDS, {"price_tier": "string"})
CLICK = EventKind("click", "ecommerce.clicks", CLICK_FIELDS, {"engagement": "string"})
PAYMENT = EventKind(
    "payment", "ecommerce.payments", PAYMENT_FIELDS, {"is_successful": "boolean"}
)
KINDS = (ORDER, CLICK, PAYMENT)
TOPICS = tuple(kind.topic for kind in KINDS)
