"""Raw collections. Scalars are typed; nested values stay JSON text until staging."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine collections and the columns the models read. Other fields are found in the pages.
COLLECTIONS = {
    "orders": "id bigint, customer string, customerEmail string, items string, amount bigint,"
              " currency string, status string, createdAt timestamp, updatedAt timestamp",
    "transactions": "id bigint, order string, customer string, amount bigint, currency string,"
                    " paymentMethod string, status string, createdAt timestamp, updatedAt timestamp",
    "carts": "id bigint, customer string, items string, currency string, subtotal bigint,"
             " purchasedAt timestamp, createdAt timestamp, updatedAt timestamp",
    "products": "id bigint, title string, slug string, description string, priceInUSD bigint,"
                " inventory bigint, enableVariants boolean, categories string, _status string,"
                " createdAt timestamp, updatedAt timestamp",
    "variants": "id bigint, title string, product string, priceInUSD bigint, inventory bigint,"
                " options string, createdAt timestamp, updatedAt timestamp",
    "categories": "id bigint, title string, slug string, createdAt timestamp, updatedAt timestamp",
    "users": "id bigint, name string, email string, roles string, createdAt timestamp,"
             " updatedAt timestamp",
    "variantTypes": "id bigint, label string, name string, createdAt timestamp,"
                    " updatedAt timestamp",
    "variantOptions": "id bigint, variantType string, label string, value string,"
                      " createdAt timestamp, updatedAt timestamp",
}
PRIMARY_KEY = "id"
CURSOR = "updatedAt"
INITIAL_TIMESTAMP = "2024-01-01T00:00:00Z"


def collection_schema(name: str, zoned: bool = True) -> T.StructType:
    """Schema of one collection; ``zoned=False`` reads timestamps without a zone."""
    ddl = COLLECTIONS[name]
    return T.StructType.fromDDL(ddl if zoned else ddl.replace("timestamp", "timestamp_ntz"))


def page_schema(documents: T.StructType) -> T.StructType:
    """Envelope of one landed page; only the fields the reader uses are declared."""
    return T.StructType([T.StructField("docs", T.ArrayType(documents))])
