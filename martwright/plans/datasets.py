"""The nine datasets as data: raw file, columns, key and silver rules."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Dataset:
    """One dataset.

    ``required`` maps each contract column to its type, ``optional`` the further columns the public
    files carry. ``key`` empty means the whole row. ``first_between`` is checked before the
    deduplication, everything else after it.
    """

    name: str
    raw_file: str
    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    first_between: tuple[str, int, int] | None = None
    not_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    multiline: bool = False

    @property
    def types(self) -> dict[str, str]:
        return {**self.required, **self.optional}

    def missing(self, columns: list[str]) -> list[str]:
        """Contract columns that ``columns`` lacks; names must match in case too."""
        return [name for name in self.required if name not in columns]


# Dataset names, raw file names, column names (two of them misspelt at the source),
# keys and rules. The order is the processing order.
DATASETS: dict[str, Dataset] = {
    dataset.name: dataset
    for dataset in (
        Dataset(
            name="customers",
            raw_file="olist_customers_dataset.csv",
            required={
                "customer_id": "string",
                "customer_unique_id": "string",
                "customer_zip_code_prefix": "string",
                "customer_city": "string",
                "customer_state": "string",
            },
            key=("customer_id",),
            not_null=("customer_id", "customer_unique_id"),
        ),
        Dataset(
            name="geolocation",
            raw_file="olist_geolocation_dataset.csv",
            required={
                "geolocation_zip_code_prefix": "string",
                "geolocation_lat": "double",
                "geolocation_lng": "double",
                "geolocation_city": "string",
                "geolocation_state": "string",
            },
            key=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            not_null=("geolocation_zip_code_prefix",),
        ),
        Dataset(
            name="order_items",
            raw_file="olist_order_items_dataset.csv",
            required={
                "order_id": "string",
                "order_item_id": "int",
                "product_id": "string",
                "seller_id": "string",
                "price": "decimal(18,2)",
                "freight_value": "decimal(18,2)",
            },
            optional={"shipping_limit_date": "timestamp_ntz"},
            key=("order_id", "order_item_id"),
            not_null=("order_id", "product_id", "seller_id"),
            positive=("price",),
            non_negative=("freight_value",),
        ),
        Dataset(
            name="orders",
            raw_file="olist_orders_dataset.csv",
            required={
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "timestamp_ntz",
            },
            optional={
                "order_approved_at": "timestamp_ntz",
                "order_delivered_carrier_date": "timestamp_ntz",
                "order_delivered_customer_date": "timestamp_ntz",
                "order_estimated_delivery_date": "timestamp_ntz",
            },
            key=("order_id",),
            not_null=("order_id", "customer_id", "order_status"),
        ),
        Dataset(
            name="payments",
            raw_file="olist_order_payments_dataset.csv",
            required={
                "order_id": "string",
                "payment_sequential": "int",
                "payment_type": "string",
                "payment_installments": "int",
                "payment_value": "decimal(18,2)",
            },
            key=("order_id", "payment_sequential"),
            positive=("payment_value", "payment_installments"),
        ),
        Dataset(
            name="products",
            raw_file="olist_products_dataset.csv",
            required={
                "product_id": "string",
                "product_category_name": "string",
                "product_name_lenght": "int",
                "product_description_lenght": "int",
                "product_photos_qty": "int",
                "product_weight_g": "int",
                "product_length_cm": "int",
                "product_height_cm": "int",
                "product_width_cm": "int",
            },
            key=("product_id",),
            positive=("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
        ),
        Dataset(
            name="reviews",
            raw_file="olist_order_reviews_dataset.csv",
            required={"review_id": "string", "order_id": "string", "review_score": "int"},
            optional={
                "review_comment_title": "string",
                "review_comment_message": "string",
                "review_creation_date": "timestamp_ntz",
                "review_answer_timestamp": "timestamp_ntz",
            },
            key=("review_id",),
            first_between=("review_score", 1, 5),
            multiline=True,
        ),
        Dataset(
            name="sellers",
            raw_file="olist_sellers_dataset.csv",
            required={
                "seller_id": "string",
                "seller_zip_code_prefix": "string",
                "seller_city": "string",
                "seller_state": "string",
            },
            key=("seller_id",),
            not_null=("seller_id",),
        ),
        Dataset(
            name="categories",
            raw_file="product_category_name_translation.csv",
            required={"product_category_name": "string", "product_category_name_english": "string"},
        ),
    )
}
