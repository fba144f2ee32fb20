"""The five landed datasets.

Fixed values: field names and types as they stand in the input files. All fields
are nullable. The schema of the place dataset is inferred; its plain fields have fixed types.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    ddl: str | None = None
    # text column -> timestamp column derived from it at landing
    timestamps: dict[str, str] = field(default_factory=dict)
    # types that an inferred schema gets at landing, whatever values one file happens to hold
    types: dict[str, str] = field(default_factory=dict)

    @property
    def json_schema(self) -> T.StructType | None:
        return T.StructType.fromDDL(self.ddl) if self.ddl else None

    @property
    def table_schema(self) -> T.StructType | None:
        """Schema of the landed Parquet files."""
        schema = self.json_schema
        if schema is not None:
            for name in self.timestamps.values():
                schema = schema.add(name, T.TimestampNTZType())
        return schema


DATASETS = {
    "business": Dataset(types={
        **dict.fromkeys(("business_id", "name", "address", "city", "state", "postal_code", "categories"), "string"),
        **dict.fromkeys(("latitude", "longitude", "stars"), "double"),
        **dict.fromkeys(("review_count", "is_open"), "bigint"),
    }),
    "checkin": Dataset("business_id STRING, date STRING"),
    "review": Dataset(
        "review_id STRING, user_id STRING, business_id STRING, stars DOUBLE, useful BIGINT, "
        "funny BIGINT, cool BIGINT, text STRING, date STRING",
        {"date": "date_ts"},
    ),
    "tip": Dataset(
        "user_id STRING, business_id STRING, text STRING, date STRING, compliment_count BIGINT",
        {"date": "date_ts"},
    ),
    "user": Dataset(
        "user_id STRING, name STRING, review_count BIGINT, yelping_since STRING, useful BIGINT, "
        "funny BIGINT, cool BIGINT, elite STRING, friends STRING, fans BIGINT, "
        "average_stars DOUBLE, compliment_hot BIGINT, compliment_more BIGINT, "
        "compliment_profile BIGINT, compliment_cute BIGINT, compliment_list BIGINT, "
        "compliment_note BIGINT, compliment_plain BIGINT, compliment_cool BIGINT, "
        "compliment_funny BIGINT, compliment_writer BIGINT, compliment_photos BIGINT"
    ),
}
