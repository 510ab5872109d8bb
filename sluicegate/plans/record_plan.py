"""What a kind of record looks like on its way through the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.functions import Average, Between, Required, Rule, as_type, from_epoch_seconds
from sluicegate.operators import Field, Order


@dataclass(frozen=True)
class RecordPlan:
    """Everything the jobs need to know about one kind of record."""

    bronze: T.StructType
    fields: tuple[Field, ...]
    scored: tuple[str, ...]
    rules: tuple[Rule, ...]
    key: tuple[str, ...]
    latest: tuple[Order, ...]

    def field(self, target: str) -> Field:
        return next(f for f in self.fields if f.target == target)


_text, _number, _whole = T.StringType(), T.DoubleType(), T.LongType()

# Names and types of the raw records, as the source delivers them.
PRODUCT_BRONZE = (
    T.StructType()
    .add("_id", _text)
    .add("code", _text)
    .add("product_name", _text)
    .add("brands", _text)
    .add("categories", _text)
    .add("countries", _text)
    .add("ingredients_text", _text)
    .add("allergens", _text)
    .add("nutrition_grades", _text)
    .add("last_modified_t", _whole)
    .add(
        "nutriments",
        T.StructType()
        .add("energy-kcal_100g", _number)
        .add("fat_100g", _number)
        .add("proteins_100g", _number)
        .add("salt_100g", _number)
        .add("sugars_100g", _number),
    )
)

# The key is used as it comes: only a null one falls back, and it is not trimmed.
PRODUCT_FIELDS = (
    Field("barcode", ("code", "_id")),
    Field("product_name", ("product_name",), (F.trim,)),
    Field("brand", ("brands",), (F.trim,)),
    Field("categories", ("categories",), (F.trim,)),
    Field("countries", ("countries",), (F.trim,)),
    Field("ingredients_text", ("ingredients_text",), (F.trim,)),
    Field("allergens", ("allergens",), (F.trim,)),
    Field("nutrition_grade", ("nutrition_grades",), (F.trim, F.lower)),
    Field("source_last_modified_timestamp", ("last_modified_t",), (as_type("long"),)),
    Field("energy_kcal_100g", ("nutriments.`energy-kcal_100g`",), (as_type("double"),)),
    Field("fat_100g", ("nutriments.fat_100g",), (as_type("double"),)),
    Field("proteins_100g", ("nutriments.proteins_100g",), (as_type("double"),)),
    Field("salt_100g", ("nutriments.salt_100g",), (as_type("double"),)),
    Field("sugars_100g", ("nutriments.sugars_100g",), (as_type("double"),)),
    Field(
        "source_last_modified_at",
        ("last_modified_t",),
        (as_type("long"), from_epoch_seconds),
    ),
)

# The columns that count towards the completeness score.
PRODUCT_SCORED = (
    "barcode",
    "product_name",
    "brand",
    "categories",
    "countries",
    "ingredients_text",
    "nutrition_grade",
    "energy_kcal_100g",
    "fat_100g",
    "proteins_100g",
    "salt_100g",
    "sugars_100g",
)

# Labels, bounds and their order in the reason text.
PRODUCT_RULES = (
    Required("barcode", "missing_barcode"),
    Required("product_name", "missing_product_name"),
    Between("sugars_100g", 0, 100, "invalid_sugars_100g"),
    Between("fat_100g", 0, 100, "invalid_fat_100g"),
    Between("proteins_100g", 0, 100, "invalid_proteins_100g"),
    Between("salt_100g", 0, 100, "invalid_salt_100g"),
    Between("energy_kcal_100g", 0, 1000, "invalid_energy_kcal_100g"),
)

# Newest first.  Rows that tie differ in content only; ordering by all of it makes the
# choice the same on every run.
PRODUCT_LATEST = (
    Order("source_last_modified_timestamp", descending=True),
    Order("processed_at", descending=True),
    Order("product_name"),
    Order("brand"),
    Order("categories"),
    Order("countries"),
    Order("ingredients_text"),
    Order("nutrition_grade"),
    Order("energy_kcal_100g"),
    Order("fat_100g"),
    Order("proteins_100g"),
    Order("salt_100g"),
    Order("sugars_100g"),
    Order("allergens"),
)

PRODUCTS = RecordPlan(
    bronze=PRODUCT_BRONZE,
    fields=PRODUCT_FIELDS,
    scored=PRODUCT_SCORED,
    rules=PRODUCT_RULES,
    key=("barcode",),
    latest=PRODUCT_LATEST,
)

# Averaged columns and digits of the summary tables.
BRAND_AVERAGES = (
    Average("completeness_score", 4),
    Average("sugars_100g", 2),
    Average("fat_100g", 2),
    Average("energy_kcal_100g", 2),
)
CANONICAL_BRAND_AVERAGES = (
    Average("energy_kcal_100g", 2),
    Average("proteins_100g", 2),
    Average("fat_100g", 2),
    Average("sugars_100g", 2),
    Average("completeness_score", 4),
)
GRADE_AVERAGES = (
    Average("sugars_100g", 2),
    Average("fat_100g", 2),
    Average("salt_100g", 3),
    Average("energy_kcal_100g", 2),
    Average("completeness_score", 4),
)
UNKNOWN_BRAND = "Unknown"
UNKNOWN_GRADE = "unknown"
