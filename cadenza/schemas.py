"""S3: the four event schemas, all fields nullable, and the topic registry."""

from pyspark.sql.types import StructType


def _schema(fields: str) -> StructType:
    """'name type, name type, ...'; unlike StructType.fromDDL it needs no session."""
    schema = StructType()
    for field in fields.split(","):
        schema.add(*field.split())
    return schema


# Names, types and order of the fields as they come over the wire.
EVENT_SCHEMAS: dict[str, StructType] = {
    topic: _schema(fields)
    for topic, fields in {
        "auth_events": """
            ts long, sessionId long, level string, itemInSession integer, city string, zip string,
            state string, userAgent string, lon float, lat float, userId integer, lastName string,
            firstName string, gender string, registration long, success boolean
        """,
        "listen_events": """
            artist string, song string, duration float, ts long, sessionId integer, auth string,
            level string, itemInSession integer, city string, zip string, state string,
            userAgent string, lon float, lat float, userId integer, lastName string, firstName string,
            gender string, registration long
        """,
        "page_view_events": """
            ts long, sessionId integer, page string, auth string, method string, status integer,
            level string, itemInSession integer, city string, zip string, state string,
            userAgent string, lon float, lat float, userId integer, lastName string, firstName string,
            gender string, registration long, artist string, song string, duration float
        """,
        "status_change_events": """
            ts long, sessionId integer, auth string, level string, itemInSession integer, city string,
            zip string, state string, userAgent string, lon float, lat float, userId integer,
            lastName string, firstName string, gender string, registration long
        """,
    }.items()
}

TOPICS = list(EVENT_SCHEMAS)

LEDGER_SCHEMA = _schema(
    "file_path string, topic string, batch_id long, status string, ingested_at timestamp, "
    "load_id long"
)
