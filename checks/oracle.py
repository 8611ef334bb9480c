"""DuckDB SQL for what the registered queries should give, written on its own, not from the Spark code.

Each statement starts from the given tables. `with_(...)` puts the needed steps in front of it; the
steps build on each other in the order in which they stand here.
"""

from souqframe.schemas import ORDER_FIELDS

_AR, _WE = "٠١٢٣٤٥٦٧٨٩", "0123456789"

AMOUNTS = ["delivery_cost", "payment_amount", "total_amount"]
# The fields that rule 8 tidies, in the order of its corrections.
TIDIED = [
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


def _western(x: str) -> str:
    return f"translate({x}, '{_AR}', '{_WE}')"


def _arabic(x: str) -> str:
    return f"translate({x}, '{_WE}', '{_AR}')"


def _clean(x: str) -> str:
    return f"regexp_replace(trim({x}), '\\s+', ' ', 'g')"


def _numeric(x: str) -> str:
    return f"trim(replace(replace(replace({_western(x)}, '٫', '.'), '٬', ''), ',', ''))"


def _no_currency(x: str) -> str:
    pattern = r"(?i)\s*(ريال\s*يمني|ريال|ر\.ي|YER|Y\.R\.?)\s*"
    return f"trim(regexp_replace({_western(x)}, '{pattern}', '', 'g'))"


def _currency(x: str) -> str:
    return (
        f"CASE WHEN lower({_clean(x)}) IN ('yer', 'y.r', 'y.r.', 'ر.ي') THEN 'YER' "
        f"WHEN contains({_clean(x)}, 'ريال') THEN 'YER' ELSE {_clean(x)} END"
    )


def _words(x: str) -> str:
    words = {
        "صفر": 0, "واحد": 1, "اثنان": 2, "اثنين": 2, "ثلاثة": 3, "أربعة": 4, "خمسة": 5,
        "ستة": 6, "سبعة": 7, "ثمانية": 8, "تسعة": 9, "عشرة": 10,
    }
    cases = " ".join(f"WHEN '{word}' THEN '{digits}'" for word, digits in words.items())
    return f"CASE trim({x}) {cases} ELSE {x} END"


def _phone(x: str) -> str:
    bare = f"regexp_replace({_western(x)}, '[\\s().-]', '', 'g')"
    no_plus = f"regexp_replace({bare}, '^\\+967', '967')"
    no_zeros = f"regexp_replace({no_plus}, '^00967', '967')"
    local = f"regexp_replace({no_zeros}, '^07(\\d{{8}})$', '9677\\1')"
    return f"regexp_replace({local}, '^7(\\d{{8}})$', '9677\\1')"


def _email(x: str) -> str:
    bare = f"regexp_replace({x}, '\\s+', '', 'g')"
    return f"regexp_replace(regexp_replace({bare}, '@{{2,}}', '@', 'g'), '\\.{{2,}}', '.', 'g')"


def _date(x: str) -> str:
    iso, dmy, clock = r"\d{4}-\d{2}-\d{2}", r"\d{2}/\d{2}/\d{4}", r"\d{2}:\d{2}:\d{2}"
    shapes = [
        (f"{iso}T{clock}", "%Y-%m-%dT%H:%M:%S"),
        (f"{iso} {clock}", "%Y-%m-%d %H:%M:%S"),
        (f"{dmy} {clock}", "%d/%m/%Y %H:%M:%S"),
        (f"{dmy.replace('/', '-')} {clock}", "%d-%m-%Y %H:%M:%S"),
        (f"{iso.replace('-', '/')} {clock}", "%Y/%m/%d %H:%M:%S"),
        (dmy, "%d/%m/%Y"),
        (dmy.replace("/", "-"), "%d-%m-%Y"),
        (iso, "%Y-%m-%d"),
        (iso.replace("-", "/"), "%Y/%m/%d"),
    ]
    tries = " ".join(
        f"WHEN regexp_full_match({_western(x)}, '{shape}') "
        f"THEN strftime(try_strptime({_western(x)}, '{layout}'), '%Y-%m-%d')"
        for shape, layout in shapes
    )
    return f"coalesce(CASE {tries} END, {x})"


def _tidy(x: str) -> str:
    return (
        f"CASE lower({_clean(x)}) WHEN 'confirmed' THEN 'مؤكد' WHEN 'pending' THEN 'قيد الانتظار' "
        f"WHEN 'shipped' THEN 'قيد الشحن' WHEN 'returned' THEN 'مرتجع' ELSE {_clean(x)} END"
    )


def _double(x: str) -> str:
    number = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    return f"CASE WHEN regexp_full_match({x}, '{number}') THEN try_cast({x} AS DOUBLE) END"


def _amount(x: str) -> str:
    bare = f"replace(replace(coalesce({x}, '0'), ',', ''), ' ', '')"
    return f"coalesce(try_cast({bare} AS DECIMAL(28,2)), 0)::DECIMAL(28,2)"


def _select(values: dict[str, str], source: str) -> str:
    return "SELECT {} FROM {}".format(
        ", ".join(f"{expression} AS {name}" for name, expression in values.items()), source
    )


_STEPS: dict[str, str] = {}

# --- the raw orders --------------------------------------------------------------------------------

_STEPS["items"] = f"""
SELECT l_orderkey, '[' || string_agg(item, ',' ORDER BY l_linenumber, l_partkey, item) || ']' AS items
FROM (
  SELECT l.l_orderkey, l_linenumber, l_partkey,
    '{{"sku":"P-' || l_partkey || '","name":"' || p_name || '","qty":"' ||
      CASE WHEN l.l_orderkey % 8 = 0 THEN {_arabic("(l_quantity::BIGINT)::VARCHAR")}
           ELSE (l_quantity::BIGINT)::VARCHAR END ||
      '","unit_price":"' || printf('%.2f', p_retailprice) ||
      '","total":"' || printf('%.2f', l_quantity * p_retailprice) || '"}}' AS item
  FROM lineitem l
  JOIN part ON l_partkey = p_partkey
)
GROUP BY 1
"""

_STEPS["base"] = f"""
SELECT o_orderkey AS k, o_custkey AS ck, o_orderdate AS d, c_name, n_name, items,
  'ORD-' || o_orderkey AS name,
  lpad(((o_custkey * 7919) % 100000000)::VARCHAR, 8, '0') AS p8,
  printf('%.2f', o_totalprice) AS price
FROM orders
LEFT JOIN items ON o_orderkey = l_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
"""

_STEPS["dirty"] = _select(
    {
        "number_row_source": "k",
        "at_ingested": "(1704067200 + k)::DOUBLE",
        "k": "k",
        "order_id": "CASE WHEN k%401=0 THEN '' WHEN k%97=0 THEN '  ' || name || ' ' ELSE name END",
        "customer_id": "CASE WHEN k%53=0 THEN '' ELSE 'CUST-' || ck END",
        "customer_name": "c_name || '  X'",
        "customer_phone": (
            "CASE WHEN k%61=0 THEN '123' WHEN k%5=0 THEN '+967 7' || p8 WHEN k%5=1 THEN '009677' || p8 "
            f"WHEN k%5=2 THEN '07' || p8 WHEN k%5=3 THEN '7-' || p8 ELSE {_arabic("'07' || p8")} END"
        ),
        "customer_email": (
            "CASE WHEN k%71=0 THEN 'no-at-sign' WHEN k%4=0 THEN ' user' || ck || '..x@@example.com' "
            "ELSE 'user' || ck || '@example.com' END"
        ),
        "city": "n_name",
        "district": "'D' || (k%7)",
        "delivery_type": "'Standard'",
        "payment_method": "'Cash'",
        "payment_status": "CASE k%3 WHEN 0 THEN 'PAID' WHEN 1 THEN 'pending' ELSE 'Confirmed' END",
        "currency": (
            "CASE k%5 WHEN 0 THEN 'YER' WHEN 1 THEN 'ريال يمني' WHEN 2 THEN 'ر.ي' WHEN 3 THEN 'YER ' "
            "ELSE 'USD' END"
        ),
        "status": (
            "CASE k%6 WHEN 0 THEN 'DELIVERED' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'pending' "
            "WHEN 3 THEN 'Shipped' WHEN 4 THEN 'مؤكد' ELSE 'returned' END"
        ),
        "order_date": (
            "CASE WHEN k%103=0 THEN NULL WHEN k%89=0 THEN '2024-02-30' WHEN k%83=0 THEN '30/02/2024' "
            "WHEN k%6=0 THEN strftime(d, '%Y-%m-%d') WHEN k%6=1 THEN strftime(d, '%d/%m/%Y') "
            "WHEN k%6=2 THEN strftime(d, '%d-%m-%Y') WHEN k%6=3 THEN strftime(d, '%Y/%m/%d') "
            "WHEN k%6=4 THEN strftime(d, '%Y-%m-%d') || 'T10:11:12' "
            f"ELSE {_arabic("strftime(d, '%Y-%m-%d')")} END"
        ),
        "delivery_cost": (
            "CASE WHEN k%43=0 THEN '-500' WHEN k%47=0 THEN 'free' ELSE CASE k%9 WHEN 0 THEN '1500' "
            "WHEN 1 THEN '١٠٠٠ ريال' WHEN 2 THEN 'خمسة' WHEN 3 THEN '2,000' WHEN 4 THEN '1000 YER' "
            "WHEN 5 THEN '0' WHEN 6 THEN 'صفر' WHEN 7 THEN '١٬٥٠٠٫٥' ELSE '' END END"
        ),
        "payment_amount": "price || ' YER'",
        "total_amount": "price",
        "items_json": (
            "CASE WHEN k%59=0 THEN '{invalid_json_corrupted' WHEN k%67=0 THEN '[]' "
            "ELSE coalesce(items, '[]') END"
        ),
    },
    "base",
)

# --- the nine rules, each value beside the one before it -------------------------------------------

# (field, column before, column after, rule code), in the order of the audit trail.
TRAIL: list[tuple[str, str, str, str]] = []
_now = {field: field for field in ORDER_FIELDS}


def _rule(step: str, number: int, source: str, repairs: list, extra: str = "") -> None:
    added = []
    for field, code, change in repairs:
        before, after = _now[field], f"{field}_{number}"
        added.append(f"{change(before)} AS {after}")
        TRAIL.append((field, before, after, code))
        _now[field] = after
    _STEPS[step] = f"SELECT *{extra}, {', '.join(added)} FROM {source}"


_rule("rule1", 1, "dirty", [(f, "ARABIC_NUMBERS", _western) for f in AMOUNTS])
_rule(
    "rule2", 2, "rule1",
    [("currency", "CURRENCY_NORMALIZATION", _currency)]
    + [(f, "CURRENCY_REMOVAL", _no_currency) for f in AMOUNTS],
)
_rule("rule3", 3, "rule2", [(f, "THOUSANDS_SEPARATOR", _numeric) for f in AMOUNTS])
_rule("rule4", 4, "rule3", [("delivery_cost", "PRICE_IN_WORDS", _words)])
_rule("rule5", 5, "rule4", [("customer_phone", "PHONE_NORMALIZATION", _phone)])
_rule("rule6", 6, "rule5", [("customer_email", "EMAIL_NORMALIZATION", _email)])
_rule("rule7", 7, "rule6", [("order_date", "DATE_NORMALIZATION", _date)])
_rule("rule8", 8, "rule7", [(f, "SPACES_SYNONYMS", _tidy) for f in TIDIED])

_STEPS["parsed"] = f"""
SELECT *, {_double(_numeric(_now["delivery_cost"]))} AS delivery,
  CASE WHEN json_valid(items_json)
       THEN from_json(items_json, '[{{"qty":"VARCHAR","unit_price":"VARCHAR"}}]') END AS items
FROM rule8
"""
_STEPS["priced"] = f"""
SELECT *, list_transform(items, lambda i: {{'qty': {_double(_numeric("i.qty"))},
                                           'price': {_double(_numeric("i.unit_price"))}}}) AS lines
FROM parsed
"""
_STEPS["judged"] = """
SELECT *,
  CASE WHEN lines IS NULL THEN 'CORRUPTED_ITEMS_JSON'
       WHEN len(lines) = 0 THEN 'EMPTY_ITEMS'
       WHEN len(list_filter(lines, lambda i: coalesce(i.qty > 0 AND i.price >= 0, false))) < len(lines)
         THEN 'AMBIGUOUS_NEGATIVE_VALUE'
       WHEN delivery IS NULL THEN 'INVALID_DELIVERY_COST'
       WHEN delivery < 0 THEN 'AMBIGUOUS_NEGATIVE_VALUE' END AS total_order_error,
  list_sum(list_transform(lines, lambda i: i.qty * i.price)) AS goods
FROM priced
"""
_rule(
    "rule9", 9, "judged",
    [("total_amount", "TOTAL_ORDER_RECALCULATION",
      lambda x: f"CASE WHEN total_order_error IS NULL THEN format('{{:,.2f}}', goods + delivery) "
                f"ELSE {_numeric(x)} END")],
)

# --- audit, validation, classification -------------------------------------------------------------

_STEPS["audited"] = "SELECT *, list_filter([{}], lambda c: c IS NOT NULL) AS corrections FROM rule9".format(
    ",\n".join(
        f"CASE WHEN {before} <> {after} THEN {{'field': '{field}', 'original_value': {before}, "
        f"'corrected_value': {after}, 'rule_code': '{code}'}} END"
        for field, before, after, code in TRAIL
    )
)
_STEPS["named"] = _select(
    {
        "k": "k",
        "number_row_source": "number_row_source",
        "at_ingested": "at_ingested",
        **{field: _now[field] for field in ORDER_FIELDS},
        "total_order_error": "total_order_error",
        "corrections": "corrections",
    },
    "audited",
)
_STEPS["reasoned"] = r"""
SELECT *, list_filter([
  CASE WHEN order_id IS NULL OR trim(order_id) = '' THEN 'MISSING_ORDER_ID' END,
  CASE WHEN customer_id IS NULL OR trim(customer_id) = '' THEN 'MISSING_CUSTOMER_ID' END,
  CASE WHEN trim(customer_email) <> ''
        AND NOT regexp_full_match(customer_email, '[^@\s]+@[^@\s]+\.[^@\s]+') THEN 'INVALID_EMAIL' END,
  CASE WHEN trim(customer_phone) <> '' AND NOT regexp_full_match(customer_phone, '9677\d{8}')
       THEN 'INVALID_PHONE' END,
  CASE WHEN NOT regexp_full_match(order_date, '\d{4}-\d{2}-\d{2}') THEN 'INVALID_IMPOSSIBLE_DATE' END,
  total_order_error,
  CASE WHEN trim(delivery_cost) <> '' AND NOT regexp_full_match(delivery_cost, '-?\d+(\.\d+)?')
       THEN 'UNKNOWN_PRICE' END
], lambda r: r IS NOT NULL) AS quarantine_reasons
FROM named
"""
_STEPS["cleaned"] = f"""
SELECT *, {_amount("total_amount")} AS amount,
  CASE WHEN len(quarantine_reasons) > 0 THEN 'quarantine' WHEN len(corrections) > 0 THEN 'corrected'
       ELSE 'valid' END AS quality_status
FROM reasoned
"""
_STEPS["accepted"] = "SELECT * FROM cleaned WHERE quality_status IN ('valid', 'corrected')"

_FIELDS = ", ".join(ORDER_FIELDS)


def with_(last: str, statement: str) -> str:
    """The statement with all steps up to `last` in front of it."""
    needed = list(_STEPS)[: list(_STEPS).index(last) + 1]
    return "WITH {}\n{}".format(",\n".join(f"{step} AS ({_STEPS[step]})" for step in needed), statement)


def _rule_check(*numbered: str) -> str:
    """The values that a rule leaves in its fields, per record."""
    number = numbered[0][-1]
    values = ", ".join(f"{column} AS {column[:-2]}" for column in numbered)
    return with_(f"rule{number}", f"SELECT number_row_source, {values} FROM rule{number}")


_AVG = (
    "(cents // n + CASE WHEN 2 * (cents % n) > n OR (2 * (cents % n) = n AND (cents // n) % 2 = 1) "
    "THEN 1 ELSE 0 END)::DOUBLE / 100"
)


def _sales(key: str, total: str) -> str:
    """Count, sum and average by key; averages in whole cents, halves to the even one."""
    return (
        f"SELECT {key}, n AS total_orders, (cents::DOUBLE / 100) AS {total}, {_AVG} AS avg_order_value "
        f"FROM (SELECT {key}, count(*) AS n, (sum(amount) * 100)::HUGEINT AS cents FROM accepted GROUP BY 1)"
    )


_PRODUCTS = r"""
SELECT coalesce(nullif(i.name, ''), nullif(i.product_name, ''), nullif(i.item_name, ''), 'منتج غير معروف')
         AS product_name,
  translate(coalesce(nullif(i.qty, ''), nullif(i.quantity, '')), '٠١٢٣٤٥٦٧٨٩', '0123456789') AS q,
  translate(coalesce(nullif(i.total, ''), nullif(i.price, ''), nullif(i.unit_price, '')),
            '٠١٢٣٤٥٦٧٨٩', '0123456789') AS r
FROM (
  SELECT unnest(from_json(items_json, '[{"name":"VARCHAR","product_name":"VARCHAR","item_name":"VARCHAR",
    "qty":"VARCHAR","quantity":"VARCHAR","total":"VARCHAR","price":"VARCHAR","unit_price":"VARCHAR"}]')) AS i
  FROM accepted WHERE json_valid(items_json) AND items_json LIKE '[%'
)
"""


# Every third order with its first two items only.
_FEWER_ITEMS = """(
SELECT CASE WHEN number_row_source % 3 = 0 AND len(string_split(items_json, '}')) > 2
            THEN string_split(items_json, '}')[1] || '}' || string_split(items_json, '}')[2] || '}]'
            ELSE items_json END AS items_json
FROM accepted)"""


def _top_products(limit: int, source: str = "accepted") -> str:
    products = _PRODUCTS.replace("FROM accepted", f"FROM {source}")
    return rf"""
SELECT product_name,
  sum(CASE WHEN regexp_full_match(q, '\s*[+-]?\d+\s*') THEN try_cast(q AS BIGINT) ELSE 1 END)::BIGINT
    AS total_quantity_sold,
  round(sum(CASE WHEN regexp_full_match(r, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')
                 THEN try_cast(r AS DECIMAL(28,6)) ELSE 0 END), 2)::DOUBLE AS total_revenue
FROM ({products}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {limit}
"""


_LOOKUP = "order_id, customer_id, city, status, order_date, customer_email, customer_phone, amount::DOUBLE AS amount"

# The second batch of the upsert checks: every third order again, later, with another day and amount.
_RELOADED = """
SELECT order_id,
  CASE WHEN k % 3 = 0 THEN '2030-01-' || lpad((1 + k % 28)::VARCHAR, 2, '0') ELSE order_date END AS order_date,
  CASE WHEN k % 3 = 0 THEN amount + 1 ELSE amount END AS amount,
  CASE WHEN k % 3 = 0 THEN at_ingested + 100000000 ELSE at_ingested END AS at_ingested
FROM accepted
"""
_DAILY = (
    "SELECT order_date, count(*) AS total_orders, sum(amount)::DOUBLE AS total_revenue "
    "FROM {} WHERE order_date IS NOT NULL GROUP BY 1"
)

_NUMBERED = (
    "SELECT row_number() OVER (ORDER BY d.number_row_source) AS number_row_source, order_id, items_json "
    "FROM dirty d"
)

_HELPERS = {
    "clean_text": _clean("c_name || '  ' || chr(9) || 'X '"),
    "arabic_to_western": _western(_arabic("(c_acctbal::DECIMAL(18,2))::VARCHAR")),
    "normalize_numeric_text": _numeric(
        f"' ' || replace({_arabic('(c_acctbal::DECIMAL(18,2))::VARCHAR')}, '.', '٫') || '٬٠,٠ '"
    ),
    "normalize_currency_text": _currency(
        "CASE c_custkey % 4 WHEN 0 THEN ' y.R. ' WHEN 1 THEN 'ريال  سعودي' WHEN 2 THEN 'ر.ي' "
        "ELSE c_mktsegment END"
    ),
    "remove_currency": _no_currency(
        "(c_custkey)::VARCHAR || CASE c_custkey % 3 WHEN 0 THEN ' yer x' WHEN 1 THEN ' ريال يمني' "
        "ELSE ' Y.R. ' END"
    ),
    "numeric_amount": (
        _amount("CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE format('{:,.2f}', c_acctbal) END")
        + "::DOUBLE"
    ),
}


def oracle_sql() -> dict[str, str]:
    return {
        "helper_functions": _select({"c_custkey": "c_custkey", **_HELPERS}, "customer"),
        "raw_envelope": with_(
            "dirty",
            "SELECT number_row_source, at_ingested, 'pyspark' AS engine_used, "
            f"'orders.parquet' AS file_source, 'derived-orders' AS id_run, {_FIELDS} FROM dirty",
        ),
        "envelope": with_(
            "dirty",
            "SELECT 'wrapped' AS id_run, 'orders.csv' AS file_source, 'pyspark' AS engine_used, "
            f"{_FIELDS} FROM dirty",
        ),
        "correction_entry": "SELECT c_custkey, 'balance' AS field, c_custkey::VARCHAR AS original_value, "
        "(c_custkey + 1)::VARCHAR AS corrected_value, 'RULE' AS rule_code FROM customer",
        "csv_round_trip": with_(
            "dirty",
            "SELECT {} FROM dirty".format(", ".join(f"coalesce({f}, '') AS {f}" for f in ORDER_FIELDS)),
        ),
        "csv_line_breaks": with_(
            "dirty",
            "SELECT {} FROM dirty".format(
                ", ".join(
                    f"coalesce({f}, '') AS {f}"
                    if f != "customer_name"
                    else "CASE WHEN number_row_source % 3 = 0 THEN customer_name || chr(10) || 'line \"two\", of ' "
                    "|| number_row_source ELSE customer_name END AS customer_name"
                    for f in ORDER_FIELDS
                )
            ),
        ),
        "broken_records": "SELECT 'ORD-' || o_orderkey || CASE WHEN o_orderkey % 50 = 0 THEN ',CUST,only' "
        "ELSE repeat(',x', 18) END AS record, (SELECT count(*) FROM orders) AS loaded, count(*) OVER () AS broken "
        "FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 77 = 0",
        "csv_count": "SELECT count(*) AS n_rows FROM orders",
        "csv_sample": with_(
            "dirty", f"SELECT order_id, items_json FROM ({_NUMBERED}) WHERE number_row_source <= 1000"
        ),
        "exact_row_numbers": with_("dirty", f"SELECT number_row_source, order_id FROM ({_NUMBERED})"),
        "first_rows": with_(
            "dirty", f"SELECT order_id, items_json FROM ({_NUMBERED}) WHERE number_row_source <= 1000"
        ),
        "rule_arabic_numbers": _rule_check("delivery_cost_1", "payment_amount_1", "total_amount_1"),
        "rule_currency": _rule_check("currency_2", "delivery_cost_2", "payment_amount_2", "total_amount_2"),
        "rule_thousands": _rule_check("delivery_cost_3", "payment_amount_3", "total_amount_3"),
        "rule_price_words": _rule_check("delivery_cost_4"),
        "rule_phone": _rule_check("customer_phone_5"),
        "rule_email": _rule_check("customer_email_6"),
        "rule_date": _rule_check("order_date_7"),
        "rule_spaces_synonyms": _rule_check(*[f"{field}_8" for field in TIDIED]),
        "rule_total_order": with_(
            "rule9", "SELECT number_row_source, total_amount_9 AS total_amount, total_order_error FROM rule9"
        ),
        "audit_trail": with_(
            "named",
            "SELECT number_row_source, position, c.field AS field, c.original_value AS original_value, "
            "c.corrected_value AS corrected_value, c.rule_code AS rule_code "
            "FROM (SELECT number_row_source, (generate_subscripts(corrections, 1) - 1)::INTEGER AS position, "
            "unnest(corrections) AS c FROM named)",
        ),
        "validation_reasons": with_(
            "reasoned",
            "SELECT number_row_source, (generate_subscripts(quarantine_reasons, 1) - 1)::INTEGER AS position, "
            "unnest(quarantine_reasons) AS reason FROM reasoned",
        ),
        "quality_classification": with_(
            "cleaned",
            "SELECT number_row_source, quality_status, len(corrections)::INTEGER AS corrections, "
            "len(quarantine_reasons)::INTEGER AS reasons, amount::DOUBLE AS amount FROM cleaned",
        ),
        "validated_orders": with_("accepted", f"SELECT quality_status, {_FIELDS} FROM accepted"),
        "quarantined_orders": with_(
            "cleaned",
            "SELECT coalesce(nullif(order_id, ''), 'orders.parquet#' || number_row_source) AS record_key, "
            f"{_FIELDS} FROM cleaned WHERE quality_status = 'quarantine'",
        ),
        "correction_examples": with_(
            "cleaned",
            "SELECT order_id, quality_status, len(corrections)::INTEGER AS corrections FROM cleaned "
            "WHERE len(corrections) > 0 ORDER BY order_id, number_row_source LIMIT 10",
        ),
        "quarantine_examples": with_(
            "cleaned",
            "SELECT order_id, customer_id, quality_status, array_to_string(quarantine_reasons, ',') AS reasons "
            "FROM cleaned WHERE quality_status = 'quarantine' "
            "ORDER BY order_id, number_row_source LIMIT 10",
        ),
        "quality_summary": with_(
            "cleaned", "SELECT quality_status, count(*) AS count FROM cleaned GROUP BY 1"
        ),
        "quarantine_reason_summary": with_(
            "cleaned",
            "SELECT reason, count(*) AS count FROM (SELECT unnest(quarantine_reasons) AS reason FROM cleaned) "
            "GROUP BY 1",
        ),
        "reconciliation": with_(
            "cleaned",
            "SELECT (SELECT count(*) FROM dirty) AS raw, count(*) AS processed, "
            "count(*) FILTER (quality_status <> 'quarantine') AS validated, "
            "count(*) FILTER (quality_status = 'quarantine') AS quarantined FROM cleaned",
        ),
        "sales_by_city": with_("accepted", _sales("city", "total_revenue")),
        "top_products": with_("accepted", _top_products(10)),
        "top_customers": with_(
            "accepted", _sales("customer_id", "total_spent") + " ORDER BY total_spent DESC, customer_id LIMIT 10"
        ),
        "sales_by_period": with_("accepted", _sales("order_date", "total_revenue")),
        "orders_by_status": with_(
            "accepted",
            "SELECT status, count(*) AS order_count, sum(amount)::DOUBLE AS total_amount FROM accepted GROUP BY 1",
        ),
        "customer_orders": with_(
            "accepted",
            f"SELECT {_LOOKUP} FROM accepted WHERE customer_id = 'CUST-7' "
            "ORDER BY accepted.order_date DESC NULLS LAST, accepted.order_id LIMIT 10",
        ),
        "orders_by_city_status": with_(
            "accepted",
            f"SELECT {_LOOKUP} FROM accepted WHERE city = 'NATION_3' AND status = 'DELIVERED' "
            "ORDER BY accepted.order_id LIMIT 10",
        ),
        "orders_by_date_range": with_(
            "accepted",
            f"SELECT {_LOOKUP} FROM accepted WHERE order_date BETWEEN '1997-01-01' AND '1997-03-31' "
            "ORDER BY accepted.order_id LIMIT 10",
        ),
        "orders_by_contact": with_(
            "accepted",
            f"SELECT {_LOOKUP} FROM accepted WHERE customer_email = 'user7@example.com' "
            "OR customer_phone = 'user7@example.com' ORDER BY accepted.order_id LIMIT 10",
        ),
        "high_value_orders": with_(
            "accepted",
            f"SELECT {_LOOKUP} FROM accepted WHERE amount >= 500 "
            "ORDER BY accepted.amount DESC, accepted.order_id LIMIT 10",
        ),
        "upsert_two_batches": with_(
            "accepted", f"SELECT order_id, order_date, amount::DOUBLE AS amount, at_ingested FROM ({_RELOADED})"
        ),
        "quarantine_table": with_(
            "cleaned",
            "SELECT coalesce(nullif(order_id, ''), 'orders.parquet#' || number_row_source) AS record_key, "
            "count(*) AS row_count FROM cleaned WHERE quality_status = 'quarantine' GROUP BY 1",
        ),
        "missing_keys": with_(
            "accepted",
            "SELECT DISTINCT order_id FROM cleaned WHERE quality_status = 'quarantine' "
            "AND order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM accepted)",
        ),
        "exclusive_tables": with_(
            "cleaned",
            "SELECT quality_status <> 'quarantine' AS validated, "
            "coalesce(nullif(order_id, ''), 'orders.parquet#' || number_row_source) AS record_key FROM cleaned",
        ),
        "elt_tables": with_(
            "cleaned",
            "SELECT CASE WHEN quality_status = 'quarantine' "
            "THEN coalesce(nullif(order_id, ''), 'orders.parquet#' || number_row_source) ELSE order_id END AS record_key, "
            f"quality_status, {_FIELDS}, len(corrections)::INTEGER AS corrections, "
            "array_to_string(quarantine_reasons, ',') AS reasons, amount::DOUBLE AS amount FROM cleaned",
        ),
        "reset_tables": with_(
            "accepted", "SELECT order_id, 0::BIGINT AS left_by_reset FROM accepted WHERE number_row_source % 3 = 0"
        ),
        "everything": with_(
            "cleaned",
            # In an order file a missing date is an empty text, and that is not a date.
            "SELECT loaded, validated, loaded - validated AS quarantined, validated AS in_report, validated AS in_days, "
            "3::BIGINT AS lookups, 2::BIGINT AS jobs_done, 2::BIGINT AS jobs_logged, true AS idempotent "
            "FROM (SELECT count(*) AS loaded, "
            "count(*) FILTER (quality_status <> 'quarantine' AND order_date IS NOT NULL) AS validated FROM cleaned)",
        ),
        "mv_top_products_incremental": with_("accepted", _top_products(50, _FEWER_ITEMS)),
        "daily_delta": with_(
            "accepted",
            "SELECT order_date, count(*) AS inc_orders, sum(amount)::DOUBLE AS inc_revenue, "
            "max(at_ingested) AS latest_ingested FROM accepted "
            "WHERE at_ingested > 1704067900 AND order_date IS NOT NULL GROUP BY 1",
        ),
        "mv_daily_full": with_("accepted", _DAILY.format("accepted")),
        "mv_daily_incremental": with_("accepted", _DAILY.format(f"({_RELOADED})")),
        "mv_daily_stream": with_("accepted", _DAILY.format(f"({_RELOADED})")),
        "mv_top_products": with_("accepted", _top_products(50)),
        "mv_watermark": with_(
            "accepted",
            f"SELECT 'daily_sales_summary' AS mv_name, max(at_ingested) AS last_at_ingested FROM ({_RELOADED})",
        ),
        "system_audit": with_(
            "cleaned",
            "SELECT count(*) FILTER (quality_status <> 'quarantine') AS validated_orders_count, "
            "count(*) FILTER (quality_status = 'quarantine') AS quarantine_orders_count, "
            "count(*) AS total_processed_orders, 'HEALTHY' AS system_health FROM cleaned",
        ),
        "repeated_upsert": with_(
            "accepted",
            "SELECT true AS idempotent, count(*) AS orders, count(DISTINCT order_id) AS order_ids FROM accepted",
        ),
        "csv_elt": with_(
            "cleaned",
            # In an order file a missing date is an empty text, and that is not a date.
            "SELECT count(*) AS raw, count(*) AS processed, "
            "count(*) FILTER (quality_status <> 'quarantine' AND order_date IS NOT NULL) AS validated, "
            "count(*) FILTER (quality_status = 'quarantine' OR order_date IS NULL) AS quarantined FROM cleaned",
        ),
        "job_log": with_(
            "accepted",
            "SELECT 'periodic_system_audit_job' AS job_name, 'SUCCESS' AS status, "
            "count(*) FILTER (quality_status <> 'quarantine') AS validated, "
            "count(*) FILTER (quality_status = 'quarantine') AS quarantined, "
            "NULL::BIGINT AS days, NULL::BIGINT AS products FROM cleaned UNION ALL "
            "SELECT 'refresh_materialized_views_job', 'SUCCESS', NULL, NULL, "
            "(SELECT count(DISTINCT order_date) FROM accepted), "
            f"(SELECT count(*) FROM ({_top_products(50)})) FROM (SELECT 1)",
        ),
        "layout_comparison": with_(
            "accepted",
            " UNION ALL ".join(
                f"SELECT '{name}' AS query_id, '{layout}' AS layout, count(*) AS rows_stored, "
                f"count(*) FILTER ({condition}) AS before_rows_returned, "
                f"count(*) FILTER ({condition}) AS after_rows_returned, true AS fewer_rows_examined, true AS fewer_files_examined FROM accepted"
                for name, layout, condition in [
                    ("Q1_customer_orders", "customer_order_date", "customer_id = 'CUST-7'"),
                    ("Q2_city_status", "city", "city = 'NATION_3' AND status = 'DELIVERED'"),
                    ("Q3_status_filter", "status", "status = 'DELIVERED'"),
                ]
            ),
        ),
    }
