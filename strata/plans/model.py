"""Wire the clean tables into the whole model (dimensions, then facts)."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame

from strata.operators.lookup import LOOKUP_ROWS, SMALL_DIM_ROWS, calendar, sized_broadcast
from strata.plans import dims, facts

DIMENSIONS = [
    "dim_date",
    "dim_customer",
    "dim_seller",
    "dim_product_category",
    "dim_order_status",
    "dim_payment_type",
    "dim_geolocation",
    "product_key_map",
]
FACTS = ["fact_order_items", "fact_orders", "fact_payments", "fact_reviews"]


class Model:
    """Lazily builds each model table once from the clean tables.

    ``clean`` maps entity name -> clean DataFrame (or a reader of the written
    clean table); ``overrides`` holds tables that are written already. A
    dimension is broadcast only behind a count of its rows, for which it is
    persisted until ``release``. With ``keep=False`` nothing is persisted or
    forced: Spark chooses the joins when a table is read."""

    def __init__(self, clean: dict[str, DataFrame], overrides: dict[str, DataFrame] | None = None, keep: bool = True):
        self.clean = clean
        self.keep = keep
        self._built: dict[str, DataFrame] = dict(overrides or {})
        self._on_disk = frozenset(self._built)
        self._kept: list[DataFrame] = []
        # tables are requested from several driver threads (one per table
        # write); each is planned once, and only its own users wait for it
        self._locks: dict[str, threading.RLock] = defaultdict(threading.RLock)
        self._guard = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name not in self._built:
                self._built[name] = getattr(self, "_" + name)()
            return self._built[name]

    def release(self) -> None:
        """Unpersist what the broadcasts were counted on."""
        while self._kept:
            self._kept.pop().unpersist()

    def _written(self, table: str, keys: str) -> str:
        """The dimension if it is written already, else its keys alone."""
        return table if table in self._on_disk else keys

    def _broadcast(self, df: DataFrame, max_rows: int) -> DataFrame:
        return sized_broadcast(df, max_rows, self._kept) if self.keep else df

    # small, broadcastable dimensions -------------------------------------
    def _dim_date(self):
        return dims.dim_date(self.clean["orders"], self.clean["order_reviews"])

    def _calendar(self):
        if "dim_date" in self._on_disk:
            return calendar(self["dim_date"].select("full_date"))
        return calendar(dims.date_values(self.clean["orders"], self.clean["order_reviews"]))

    def _dim_order_status(self):
        return dims.dim_order_status(self.clean["orders"])

    def _dim_order_status_b(self):
        return self._broadcast(self["dim_order_status"], SMALL_DIM_ROWS)

    def _dim_payment_type(self):
        return dims.dim_payment_type(self.clean["order_payments"])

    def _dim_payment_type_b(self):
        return self._broadcast(self["dim_payment_type"], SMALL_DIM_ROWS)

    def _dim_product_category(self):
        return dims.dim_product_category(self.clean["products"], self.clean["category_translation"])

    # large dimensions ------------------------------------------------------
    def _dim_customer(self):
        return dims.dim_customer(self.clean["customers"], self.clean["orders"], self["calendar"], self["customer_keys"])

    def _dim_seller(self):
        c = self.clean
        return dims.dim_seller(c["sellers"], c["order_items"], c["orders"], self["calendar"], self["seller_keys"])

    def _dim_geolocation(self):
        return dims.dim_geolocation(self.clean["geolocation"])

    def _product_key_map(self):
        return dims.product_key_map(self.clean["products"])

    # lookups that facts share ----------------------------------------------
    def _customer_keys(self):
        return dims.customer_keys(self.clean["customers"])

    def _seller_keys(self):
        return dims.seller_keys(self.clean["sellers"])

    def _customer_map(self):
        return facts.customer_map(self.clean["customers"], self[self._written("dim_customer", "customer_keys")])

    def _seller_lookup(self):
        sellers = self[self._written("dim_seller", "seller_keys")]
        return self._broadcast(sellers.select("seller_id", "seller_sk"), LOOKUP_ROWS)

    def _product_lookup(self):
        return self._broadcast(self["product_key_map"].select("product_id", "product_sk"), LOOKUP_ROWS)

    def _order_context(self):
        return facts.order_context(self.clean["orders"], self["customer_map"], self["calendar"], self["dim_order_status_b"])

    # facts -----------------------------------------------------------------
    def _fact_order_items(self):
        c = self.clean
        return facts.fact_order_items(
            c["order_items"],
            self["order_context"],
            c["order_payments"],
            c["order_reviews"],
            self["dim_payment_type_b"],
            self["seller_lookup"],
            self["product_lookup"],
        )

    def _fact_orders(self):
        c = self.clean
        return facts.fact_orders(self["order_context"], c["order_items"], c["order_payments"], c["order_reviews"])

    def _fact_payments(self):
        return facts.fact_payments(self.clean["order_payments"], self["order_context"], self["dim_payment_type_b"])

    def _fact_reviews(self):
        return facts.fact_reviews(self.clean["order_reviews"], self["order_context"], self["calendar"])
