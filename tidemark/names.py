"""Column names, operation names and accepted option values."""

OP = "_op"
TXN_ID = "_txn_id"
TOTAL_ORDER = "_total_order"
COLLECTION_ORDER = "_collection_order"
BUCKET = "_bucket"
IS_DELETED = "_is_deleted"
DELETED_AT = "_deleted_at"
BATCH_ID = "_batch_id"

META = (OP, TXN_ID, TOTAL_ORDER, COLLECTION_ORDER)
DEFAULT_ORDER = (TOTAL_ORDER, COLLECTION_ORDER, TXN_ID)

INSERT, SNAPSHOT, UPDATE, DELETE = "INSERT", "SNAPSHOT", "UPDATE", "DELETE"
INSERT_OPS = (INSERT, SNAPSHOT)
OPS = (INSERT, SNAPSHOT, UPDATE, DELETE)

SEMANTICS = ("upsert", "phased")
DELETE_MODES = ("hard", "soft", "ignore")
INSERT_MODES = ("append", "if_absent")
SINKS = ("cow", "mor", "noop", "console")
TRIGGERS = ("once", "available-now", "processing-time")
KEY_SCOPES = ("global", "partition")


def one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    """Return ``value`` lower-cased, or raise if it is not an accepted option."""
    lowered = (value or "").strip().lower()
    if lowered not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}; got {value!r}")
    return lowered
