"""Registry of the domain tables: types, keys, defaults and rules.

The registry is plain data. ``sources.catalog`` lists it as DataFrames, ``operators.quality``
checks rows against it and ``operators.dml`` fills defaults from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

LONG, INT, BOOL, DATE, TEXT = T.LongType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.StringType()
TIME = T.TimestampNTZType()
MONEY, RATE = T.DecimalType(18, 2), T.DecimalType(10, 2)

# Defaults that depend on the write, not on the table.
AS_OF, ACTOR, NEXT_ID = "<as_of>", "<actor>", "<next id>"


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = False
    length: int | None = None
    default: object = None


@dataclass(frozen=True)
class Check:
    """Row rule as a Spark SQL expression; a NULL outcome passes."""

    name: str
    expr: str


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    unique: tuple[tuple[str, tuple[str, ...]], ...] = ()
    checks: tuple[Check, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def defaults(self) -> dict[str, object]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    def with_check(self, check: Check) -> "Table":
        """Add a rule at run time, replacing one of the same name."""
        return replace(self, checks=tuple(c for c in self.checks if c.name != check.name) + (check,))

    def without_check(self, name: str) -> "Table":
        return replace(self, checks=tuple(c for c in self.checks if c.name != name))


def _text(name: str, length: int | None = None, required: bool = False, default: object = None) -> Col:
    return Col(name, TEXT, required, length, default)


def _need(name: str, type_: T.DataType, default: object = None) -> Col:
    return Col(name, type_, True, None, default)


_CREATED = (_need("created_at", TIME, AS_OF), _text("created_by", 100, True, ACTOR))
_UPDATED = (Col("updated_at", TIME), _text("updated_by", 100))
_DELETED = (_need("is_deleted", BOOL, False), Col("deleted_at", TIME), _text("deleted_by", 100))
_AUDIT = _CREATED + _UPDATED + _DELETED


def _fk(name: str, column: str, parent: str, parent_column: str) -> ForeignKey:
    return ForeignKey(name, (column,), parent, (parent_column,))


def _build() -> dict[str, Table]:
    def status(name: str) -> ForeignKey:
        return _fk(name, "status_id", "status_master", "status_id")

    click_columns = (
        _need("click_id", LONG, NEXT_ID),
        _need("partner_id", LONG),
        _need("clicked_at", TIME),
        _need("is_suspicious", BOOL, False),
        Col("reconciliation_status_id", LONG),
    )
    tables = [
        Table(
            "status_master",
            (
                _need("status_id", LONG, NEXT_ID),
                _text("status_code", 50, True),
                _text("status_name", 100, True),
                _text("entity_type", 50, True),
                _need("is_final", BOOL, False),
                *_AUDIT,
            ),
            ("status_id",),
            unique=(("uq_status", ("entity_type", "status_code")),),
        ),
        Table(
            "status_transition",
            (
                _need("transition_id", LONG, NEXT_ID),
                _text("entity_type", 50, True),
                _need("from_status_id", LONG),
                _need("to_status_id", LONG),
                *_CREATED,
            ),
            ("transition_id",),
            foreign_keys=(
                _fk("fk_transition_from", "from_status_id", "status_master", "status_id"),
                _fk("fk_transition_to", "to_status_id", "status_master", "status_id"),
            ),
        ),
        Table(
            "commission_rule",
            (
                _need("commission_rule_id", LONG, NEXT_ID),
                _text("rule_name", 100, True),
                _need("payout_rate", RATE),
                _text("conditions"),
                *_AUDIT,
            ),
            ("commission_rule_id",),
            checks=(Check("chk_payout_rate", "payout_rate > 0"),),
        ),
        Table(
            "partner",
            (
                _need("partner_id", LONG, NEXT_ID),
                _text("partner_code", 50, True),
                _text("partner_name", 200, True),
                Col("commission_rule_id", LONG),
                *_AUDIT,
            ),
            ("partner_id",),
            unique=(("partner_partner_code_key", ("partner_code",)),),
            foreign_keys=(
                _fk("fk_partner_commission_rule", "commission_rule_id", "commission_rule", "commission_rule_id"),
            ),
        ),
        Table(
            "promotion_program",
            (
                _need("program_id", LONG, NEXT_ID),
                _text("program_name", 200, True),
                _need("budget_limit", MONEY),
                _need("start_at", TIME),
                _need("end_at", TIME),
                _need("status_id", LONG),
                *_AUDIT,
            ),
            ("program_id",),
            checks=(
                Check("chk_budget_limit", "budget_limit >= 0"),
                Check("chk_program_date", "end_at > start_at"),
            ),
            foreign_keys=(status("fk_program_status"),),
        ),
        Table(
            "voucher",
            (
                _need("voucher_id", LONG, NEXT_ID),
                _need("program_id", LONG),
                _need("status_id", LONG),
                _text("voucher_code", 100, True),
                _text("discount_type", 20, True),
                _need("discount_amount", MONEY),
                _need("issuance_limit", INT),
                _need("total_issued", INT, 0),
                _need("valid_from", TIME),
                _need("expired_at", TIME),
                *_AUDIT,
            ),
            ("voucher_id",),
            unique=(("voucher_voucher_code_key", ("voucher_code",)),),
            checks=(
                Check("chk_issuance_limit", "issuance_limit > 0"),
                Check("chk_total_issued", "total_issued <= issuance_limit"),
                Check("chk_voucher_date", "expired_at > valid_from"),
            ),
            foreign_keys=(
                _fk("fk_voucher_program", "program_id", "promotion_program", "program_id"),
                status("fk_voucher_status"),
            ),
        ),
        Table(
            "customer",
            (
                _need("customer_id", LONG, NEXT_ID),
                _text("first_name", 100, True),
                _text("middle_name", 100),
                _text("last_name", 100, True),
                _text("phone_number", 30, True),
                _text("email", 255),
                Col("date_of_birth", DATE),
                _text("gender", 10),
                _text("address"),
                _text("province", 100),
                _text("district", 100),
                _text("ward", 100),
                _need("status_id", LONG),
                *_AUDIT,
            ),
            ("customer_id",),
            unique=(
                ("customer_phone_number_key", ("phone_number",)),
                ("customer_email_key", ("email",)),
            ),
            foreign_keys=(status("fk_customer_status"),),
        ),
        Table(
            "partner_click",
            (
                _text("click_id", 100, True),
                _need("partner_id", LONG),
                _text("partner_code", 50, True),
                _text("ip_address", 100),
                _need("clicked_at", TIME, AS_OF),
                _need("is_suspicious", BOOL, False),
                _need("is_orphaned", BOOL, False),
                Col("reconciliation_status_id", LONG),
                Col("reconciled_at", TIME),
                _text("reconciled_by", 100),
                *_CREATED,
                *_DELETED,
            ),
            ("click_id",),
            foreign_keys=(_fk("fk_click_partner", "partner_id", "partner", "partner_id"),),
        ),
        Table(
            "customer_voucher",
            (
                _need("customer_voucher_id", LONG, NEXT_ID),
                _need("customer_id", LONG),
                _need("voucher_id", LONG),
                _text("click_id", 100),
                Col("partner_id", LONG),
                Col("order_id", LONG),
                _text("order_external_code", 100),
                _need("status_id", LONG),
                _need("saved_at", TIME, AS_OF),
                Col("applied_at", TIME),
                Col("refunded_at", TIME),
                Col("cancelled_at", TIME),
                *_AUDIT,
            ),
            ("customer_voucher_id",),
            foreign_keys=(
                _fk("fk_cv_customer", "customer_id", "customer", "customer_id"),
                _fk("fk_cv_voucher", "voucher_id", "voucher", "voucher_id"),
                _fk("fk_cv_click", "click_id", "partner_click", "click_id"),
                _fk("fk_cv_partner", "partner_id", "partner", "partner_id"),
                status("fk_cv_status"),
            ),
        ),
        Table(
            "affiliate_commission",
            (
                _need("commission_id", LONG, NEXT_ID),
                _need("customer_voucher_id", LONG),
                _need("commission_rule_id", LONG),
                _need("status_id", LONG),
                _need("payout_rate", RATE),
                _need("commission_amount", MONEY),
                Col("approved_at", TIME),
                Col("paid_at", TIME),
                _text("rejection_reason"),
                *_AUDIT,
            ),
            ("commission_id",),
            foreign_keys=(
                _fk("fk_commission_cv", "customer_voucher_id", "customer_voucher", "customer_voucher_id"),
                _fk("fk_commission_rule", "commission_rule_id", "commission_rule", "commission_rule_id"),
                status("fk_commission_status"),
            ),
        ),
        Table(
            "commission_adjustment",
            (
                _need("adjustment_id", LONG, NEXT_ID),
                _need("commission_id", LONG),
                _need("amount", MONEY),
                _text("reason"),
                _need("status_id", LONG),
                *_CREATED,
            ),
            ("adjustment_id",),
            foreign_keys=(
                _fk("fk_adjustment_commission", "commission_id", "affiliate_commission", "commission_id"),
                status("fk_adjustment_status"),
            ),
        ),
        Table(
            "budget_transaction",
            (
                _need("transaction_id", LONG, NEXT_ID),
                _need("program_id", LONG),
                _text("entry_type", 20, True),
                _need("amount", MONEY),
                _text("description"),
                _text("reference_id", 100),
                _text("reference_type", 50),
                *_AUDIT,
            ),
            ("transaction_id",),
            checks=(
                Check("chk_entry_type", "entry_type IN ('income', 'spend', 'adjustment')"),
                Check("chk_amount", "amount != 0"),
            ),
            foreign_keys=(_fk("fk_bt_program", "program_id", "promotion_program", "program_id"),),
        ),
        Table(
            "promotion_program_history",
            (
                _need("history_id", LONG, NEXT_ID),
                _need("program_id", LONG),
                _text("old_program_name", 200),
                Col("old_budget_limit", MONEY),
                Col("old_start_at", TIME),
                Col("old_end_at", TIME),
                Col("old_status_id", LONG),
                _need("changed_at", TIME, AS_OF),
                _text("changed_by", 100, True, ACTOR),
                _text("change_type", 20, True, "UPDATE"),
            ),
            ("history_id",),
            foreign_keys=(_fk("fk_history_program", "program_id", "promotion_program", "program_id"),),
        ),
        Table(
            "customer_profiles",
            (
                _need("profile_id", INT, NEXT_ID),
                _text("full_name", 100, True),
                _text("email", 150, True),
                _text("phone_number", 20, True),
                _text("region", 10, True),
            ),
            ("profile_id",),
            checks=(Check("customer_profiles_region_check", "region IN ('NORTH', 'SOUTH', 'CENTRAL')"),),
        ),
        Table(
            "user_region_mapping",
            (_text("username", 50, True), _text("assigned_region", 10, True)),
            ("username",),
            checks=(
                Check("user_region_mapping_assigned_region_check", "assigned_region IN ('NORTH', 'SOUTH', 'CENTRAL')"),
            ),
        ),
        Table(
            "t_config_rls",
            (_text("user_id", 30), _text("table_name", 50), _text("field_name", 50), _text("value", 255)),
            (),
        ),
        Table(
            "Product",
            (_text("ProductID", 30, True), _text("ProductName", 255), Col("Price", RATE)),
            ("ProductID",),
        ),
        Table(
            "Vendor",
            (_text("VendorID", 10, True), _text("VendorName", 255), _text("Address", 500)),
            ("VendorID",),
        ),
        Table(
            "DeliveryMethod",
            (_text("DeliveryMethodID", 10, True), _text("DeliveryMethodName", 255)),
            ("DeliveryMethodID",),
        ),
        Table("partner_click_bench", click_columns, ("click_id",)),
        Table("partner_click_seq", click_columns, ()),
        Table("partner_click_events", click_columns, ("click_id", "clicked_at")),
        Table("partner_click_by_partner", click_columns, ("click_id", "partner_id")),
        Table("partner_click_hash", click_columns, ("click_id",)),
    ]
    return {t.name: t for t in tables}


TABLES: dict[str, Table] = _build()


@dataclass
class Registry:
    """Mutable copy of the tables, so that rules can be added and dropped at run time."""

    tables: dict[str, Table] = field(default_factory=lambda: dict(TABLES))

    def __getitem__(self, name: str) -> Table:
        return self.tables[name]

    def add_check(self, table: str, check: Check) -> Table:
        self.tables[table] = self.tables[table].with_check(check)
        return self.tables[table]

    def drop_check(self, table: str, name: str) -> Table:
        self.tables[table] = self.tables[table].without_check(name)
        return self.tables[table]
