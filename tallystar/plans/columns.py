"""The raw feed's columns and what each becomes."""
from __future__ import annotations

# The raw feed, by position.
RAW_COLUMNS = (
    "id",
    "customer_first_name", "customer_last_name", "customer_age", "customer_email",
    "customer_country", "customer_postal_code", "customer_pet_type", "customer_pet_name",
    "customer_pet_breed",
    "seller_first_name", "seller_last_name", "seller_email", "seller_country",
    "seller_postal_code",
    "product_name", "product_category", "product_price", "product_quantity",
    "sale_date", "sale_customer_id", "sale_seller_id", "sale_product_id", "sale_quantity",
    "sale_total_price",
    "store_name", "store_location", "store_city", "store_state", "store_country",
    "store_phone", "store_email",
    "pet_category",
    "product_weight", "product_color", "product_size", "product_brand", "product_material",
    "product_description", "product_rating", "product_reviews", "product_release_date",
    "product_expiry_date",
    "supplier_name", "supplier_contact", "supplier_email", "supplier_phone",
    "supplier_address", "supplier_city", "supplier_country",
)

# Columns that get another name once cleaned.
RENAMED = {
    "id": "source_row_id",
    "sale_customer_id": "source_customer_id",
    "sale_seller_id": "source_seller_id",
    "sale_product_id": "source_product_id",
    "product_quantity": "product_inventory_quantity",
}

# Columns that are not text once cleaned.
KINDS = {
    "id": "id",
    "sale_customer_id": "id",
    "sale_seller_id": "id",
    "sale_product_id": "id",
    "customer_age": "int",
    "product_quantity": "int",
    "product_reviews": "int",
    "sale_quantity": "int",
    "product_price": "decimal",
    "product_weight": "decimal",
    "sale_total_price": "decimal",
    "product_rating": "double",
    "product_release_date": "date",
    "product_expiry_date": "date",
    "sale_date": "date",
}

ENTITIES = ("customer", "seller", "supplier", "store", "product", "sale")


def raw_columns_of(entity: str) -> tuple[str, ...]:
    """An entity's raw columns: those with its prefix, in feed order."""
    extra = {"product": "pet_category", "sale": "id"}.get(entity)
    return tuple(
        name for name in RAW_COLUMNS if name.startswith(f"{entity}_") or name == extra
    )


def attributes_of(entity: str) -> tuple[str, ...]:
    """An entity's cleaned columns, in feed order; also the order its key hashes them."""
    return tuple(RENAMED.get(name, name) for name in raw_columns_of(entity))
