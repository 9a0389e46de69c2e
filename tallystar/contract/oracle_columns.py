"""What the oracles know about the feed's columns, written down apart from the package."""
from __future__ import annotations

# Each entity's raw columns in the order its key hashes them, with the kind
# that cleaning gives each.
ENTITY_COLUMNS = {
    "customer": """customer_first_name text, customer_last_name text, customer_age int,
        customer_email text, customer_country text, customer_postal_code text,
        customer_pet_type text, customer_pet_name text, customer_pet_breed text""",
    "seller": """seller_first_name text, seller_last_name text, seller_email text,
        seller_country text, seller_postal_code text""",
    "product": """product_name text, product_category text, product_price decimal,
        product_quantity int, pet_category text, product_weight decimal, product_color text,
        product_size text, product_brand text, product_material text,
        product_description text, product_rating double, product_reviews int,
        product_release_date date, product_expiry_date date""",
    "store": """store_name text, store_location text, store_city text, store_state text,
        store_country text, store_phone text, store_email text""",
    "supplier": """supplier_name text, supplier_contact text, supplier_email text,
        supplier_phone text, supplier_address text, supplier_city text,
        supplier_country text""",
    "sale": """id id, sale_date date, sale_customer_id id, sale_seller_id id,
        sale_product_id id, sale_quantity int, sale_total_price decimal""",
}

# Raw columns with another name once cleaned.
CLEANED_NAMES = {
    "id": "source_row_id",
    "sale_customer_id": "source_customer_id",
    "sale_seller_id": "source_seller_id",
    "sale_product_id": "source_product_id",
    "product_quantity": "product_inventory_quantity",
}

KIND_OF = {
    name: kind
    for columns in ENTITY_COLUMNS.values()
    for name, kind in (column.split() for column in columns.split(","))
}


def cleaned_columns(entity: str) -> tuple[str, ...]:
    names = (column.split()[0] for column in ENTITY_COLUMNS[entity].split(","))
    return tuple(CLEANED_NAMES.get(name, name) for name in names)
