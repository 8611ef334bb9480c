"""The nine cleaning rules (R1-R9) and their audit trail (A1).

A rule is a list of repairs; a repair names a field, the code that goes into the audit trail, and the
expression that gives the field's new value. Each rule adds its new values as columns beside the old
ones, and at the end every pair of before and after is compared. So the whole clean-up is a row of
projections: no shuffle, no Python worker, nothing worked out twice.
"""

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souqframe.functions.text import (
    arabic_to_western,
    clean_text,
    correction_struct,
    normalize_currency_text,
    normalize_numeric_text,
    remove_currency,
)
from souqframe.schemas import CORRECTION_SCHEMA, ORDER_FIELDS

AMOUNT_FIELDS = ["delivery_cost", "payment_amount", "total_amount"]

# The prices that may be written out in words.
PRICE_WORDS = {
    "صفر": "0",
    "واحد": "1",
    "اثنان": "2",
    "اثنين": "2",
    "ثلاثة": "3",
    "أربعة": "4",
    "خمسة": "5",
    "ستة": "6",
    "سبعة": "7",
    "ثمانية": "8",
    "تسعة": "9",
    "عشرة": "10",
}

# The date layouts that are understood, first match first.
DATE_LAYOUTS = [
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
]

# The fields that are tidied, and the words that are put in Arabic.
TIDIED_FIELDS = [
    "order_id",
    "status",
    "customer_id",
    "customer_name",
    "customer_phone",
    "customer_email",
    "city",
    "district",
    "delivery_type",
    "payment_method",
    "payment_status",
    "currency",
]
SYNONYMS = {
    "confirmed": "مؤكد",
    "pending": "قيد الانتظار",
    "shipped": "قيد الشحن",
    "returned": "مرتجع",
}

ITEMS_FOR_PRICING = "array<struct<qty:string,unit_price:string>>"
TOTAL_ERROR = "total_order_error"


def _price_in_digits(text: Column) -> Column:
    words = F.create_map(*[F.lit(part) for pair in PRICE_WORDS.items() for part in pair])
    return F.coalesce(F.try_element_at(words, F.trim(text)), text)


def _no_currency(text: Column) -> Column:
    # Most amounts are plain numbers, in which there are no words to search for.
    return F.when(text.rlike("^[0-9.,-]*$"), text).otherwise(remove_currency(text))


def _phone(text: Column) -> Column:
    bare = F.regexp_replace(arabic_to_western(text), r"[\s\-().]", "")
    international = F.regexp_replace(bare, r"^(?:\+|00)967", "967")
    return F.regexp_replace(international, r"^0?(7\d{8})$", "967$1")


def _email(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\s+", ""), r"([@.])\1+", "$1")


def _shape(layout: str) -> str:
    """A pattern that every text in the layout has, and few others."""
    years = layout.replace("'", "").replace("yyyy", r"[+-]?\d{4,}")
    return "(?i)^" + re.sub("MM|dd|HH|mm|ss", r"\\d\\d", years) + "$"


def _iso_date(text: Column, western: Column) -> Column:
    """A failed parse costs far more than a look at the shape, and most layouts fail."""
    moments = [
        F.when(western.rlike(_shape(layout)), F.try_to_timestamp(western, F.lit(layout)))
        for layout in DATE_LAYOUTS
    ]
    parsed = F.coalesce(F.date_format(F.coalesce(*moments), "yyyy-MM-dd"), text)
    # Parsed or not, such a text comes out as it went in.
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d$"), text).otherwise(parsed)


def _arabic_words(_text: Column, tidy: Column) -> Column:
    # Few words and many fields: comparisons cost a quarter of what a lookup in a map does.
    key, (first, *more) = F.lower(tidy), SYNONYMS.items()
    chosen = F.when(key == first[0], first[1])
    for word, counterpart in more:
        chosen = chosen.when(key == word, counterpart)
    return chosen.otherwise(tidy)


def _double(text: Column) -> Column:
    # What is a number as it stands stays the same number when normalized.
    return F.coalesce(text.try_cast("double"), normalize_numeric_text(text).try_cast("double"))


def _price_the_items(df: DataFrame) -> DataFrame:
    """R9a-R9e: how many items there are (null where they cannot be read) and what they come to.

    The sum is null as soon as one item has no quantity above zero or no price.
    """
    items = F.transform(
        F.from_json("items_json", ITEMS_FOR_PRICING),
        lambda item: F.struct(
            _double(item["qty"]).alias("qty"), _double(item["unit_price"]).alias("unit_price")
        ),
    )
    goods = F.aggregate(
        "_items",
        F.lit(0.0),
        lambda total, item: total
        + F.when((item["qty"] > 0) & (item["unit_price"] >= 0), item["qty"] * item["unit_price"]),
    )
    return (
        df.withColumn("_items", items)
        .withColumns({"_item_count": F.when(F.col("_items").isNotNull(), F.size("_items")), "_goods": goods})
        .drop("_items")
    )


def _price_the_order(stages: "Stages", delivery_cost: str) -> None:
    """R9f, R9g: what is needed to add items and delivery, or the reason why that cannot be done."""
    delivery = F.col("_delivery")
    stages.add("_delivery", _double(F.col(delivery_cost)), delivery_cost)
    stages.add(
        TOTAL_ERROR,
        F.when(F.col("_item_count").isNull(), "CORRUPTED_ITEMS_JSON")
        .when(F.col("_item_count") == 0, "EMPTY_ITEMS")
        .when(F.col("_goods").isNull(), "AMBIGUOUS_NEGATIVE_VALUE")
        .when(delivery.isNull(), "INVALID_DELIVERY_COST")
        .when(delivery < 0, "AMBIGUOUS_NEGATIVE_VALUE"),
        "_delivery",
    )


def _recalculated(text: Column) -> Column:
    # Without an error every part of the sum is there.
    total = F.format_number(F.col("_goods") + F.col("_delivery"), 2)
    return F.when(F.col(TOTAL_ERROR).isNull(), total).otherwise(normalize_numeric_text(text))


class Stages:
    """Columns to work out, each in the first projection in which all that it needs is there.

    Columns that do not need each other share a projection, so the rows are copied fewer times.
    """

    def __init__(self) -> None:
        self.stage_of: dict[str, int] = {}
        self.stages: dict[int, dict[str, Column]] = {}

    def add(self, name: str, value: Column, *needs: str) -> None:
        stage = 1 + max(self.stage_of.get(need, 0) for need in needs)
        self.stage_of[name] = stage
        self.stages.setdefault(stage, {})[name] = value

    def apply(self, df: DataFrame) -> DataFrame:
        for stage in sorted(self.stages):
            df = df.withColumns(self.stages[stage])
        return df


@dataclass(frozen=True)
class Repair:
    """The field's new value, from its text and, where `first` is given, what that makes of it.

    `first` is for what the new value needs several times: it becomes a column, worked out once.
    `needs` are further columns that the new value is made from.
    """

    field: str
    rule_code: str
    new_value: Callable[..., Column]
    first: Callable[[Column], Column] | None = None
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    name: str
    repairs: Sequence[Repair]
    # For a rule that looks at other fields: what it gets from the items, and from the delivery cost.
    prepare: Callable[[DataFrame], DataFrame] | None = None
    derive: Callable[[Stages, str], None] | None = None


def _each(fields: Sequence[str], rule_code: str, *how: Callable[..., Column]) -> list[Repair]:
    return [Repair(field, rule_code, *how) for field in fields]


ARABIC_NUMBERS = Rule(
    "rule_arabic_numbers", _each(AMOUNT_FIELDS, "ARABIC_NUMBERS", arabic_to_western)
)
CURRENCY = Rule(
    "rule_currency",
    [
        Repair("currency", "CURRENCY_NORMALIZATION", normalize_currency_text),
        *_each(AMOUNT_FIELDS, "CURRENCY_REMOVAL", _no_currency),
    ],
)
THOUSANDS = Rule(
    "rule_thousands", _each(AMOUNT_FIELDS, "THOUSANDS_SEPARATOR", normalize_numeric_text)
)
WORDS = Rule("rule_price_words", [Repair("delivery_cost", "PRICE_IN_WORDS", _price_in_digits)])
PHONE = Rule("rule_phone", [Repair("customer_phone", "PHONE_NORMALIZATION", _phone)])
EMAIL = Rule("rule_email", [Repair("customer_email", "EMAIL_NORMALIZATION", _email)])
DATE = Rule(
    "rule_date", [Repair("order_date", "DATE_NORMALIZATION", _iso_date, arabic_to_western)]
)
SPACES = Rule(
    "rule_spaces_synonyms", _each(TIDIED_FIELDS, "SPACES_SYNONYMS", _arabic_words, clean_text)
)
TOTAL = Rule(
    "rule_total_order",
    [Repair("total_amount", "TOTAL_ORDER_RECALCULATION", _recalculated, needs=(TOTAL_ERROR,))],
    prepare=_price_the_items,
    derive=_price_the_order,
)

# The order matters: later rules see what earlier ones left.
NINE_RULES = [ARABIC_NUMBERS, CURRENCY, THOUSANDS, WORDS, PHONE, EMAIL, DATE, SPACES, TOTAL]


def _entry_if_changed(field: str, before: str, after: str, rule_code: str) -> Column:
    """An array of one entry, or of none. A comparison with a null counts as no change."""
    return F.expr(
        f"""IF({before} != {after},
               array(named_struct('field', '{field}', 'original_value', {before},
                                  'corrected_value', {after}, 'rule_code', '{rule_code}')),
               array())"""
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Runs the rules over the order fields and adds what they changed to `corrections`.

    Every other column is kept. `total_order_error` is added when the rules include R9.
    """
    kept = [name for name in df.columns if name not in ORDER_FIELDS and name != "corrections"]
    found = [F.col("corrections")] if "corrections" in df.columns else []
    holder = {field: field for field in ORDER_FIELDS}
    stages = Stages()
    for number, rule in enumerate(rules, start=1):
        if rule.prepare and rule.derive:
            df = rule.prepare(df)
            rule.derive(stages, holder["delivery_cost"])
            kept.append(TOTAL_ERROR)
        for repair in rule.repairs:
            before, after = holder[repair.field], f"_{repair.field}_{number}"
            text = F.col(before)
            if repair.first:
                first = f"{after}_first"
                stages.add(first, repair.first(text), before)
                stages.add(after, repair.new_value(text, F.col(first)), first)
            else:
                stages.add(after, repair.new_value(text), before, *repair.needs)
            found.append(_entry_if_changed(repair.field, before, after, repair.rule_code))
            holder[repair.field] = after
    return stages.apply(df).select(
        *kept,
        *[F.col(holder[field]).alias(field) for field in ORDER_FIELDS],
        F.concat(*found).cast(CORRECTION_SCHEMA).alias("corrections"),
    )


def add_audit(df: DataFrame, original: Column, corrected: Column, field: str, rule_code: str) -> DataFrame:
    """A1 for one change of your own: appends it to `corrections` when the two values differ."""
    entry = F.array(correction_struct(field, original, corrected, rule_code))
    added = F.when(original != corrected, entry).otherwise(F.array())
    return df.withColumn("corrections", F.concat("corrections", added).cast(CORRECTION_SCHEMA))


def rule_arabic_numbers(df: DataFrame) -> DataFrame:
    """Arabic-Indic digits in the three amounts."""
    return apply_rules(df, [ARABIC_NUMBERS])


def rule_currency(df: DataFrame) -> DataFrame:
    """R2: one name for the riyal, and no currency words in the three amounts."""
    return apply_rules(df, [CURRENCY])


def rule_thousands(df: DataFrame) -> DataFrame:
    """Thousands and decimal marks in the three amounts."""
    return apply_rules(df, [THOUSANDS])


def rule_price_words(df: DataFrame) -> DataFrame:
    """A delivery cost from zero to ten written out in words."""
    return apply_rules(df, [WORDS])


def rule_phone(df: DataFrame) -> DataFrame:
    """Phones as 9677 and eight digits."""
    return apply_rules(df, [PHONE])


def rule_email(df: DataFrame) -> DataFrame:
    """No whitespace and no doubled @ or dot in e-mail addresses."""
    return apply_rules(df, [EMAIL])


def rule_date(df: DataFrame) -> DataFrame:
    """Order dates as yyyy-MM-dd; text that is no date stays as it is."""
    return apply_rules(df, [DATE])


def rule_spaces_synonyms(df: DataFrame) -> DataFrame:
    """Tidy blanks, and Arabic words for four English ones."""
    return apply_rules(df, [SPACES])


def rule_total_order(df: DataFrame) -> DataFrame:
    """The order total from its items and delivery; adds `total_order_error`."""
    return apply_rules(df, [TOTAL])
