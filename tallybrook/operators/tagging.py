"""Labels from a rule table: the rule of highest priority whose keyword stands in the texts of its scope.

Rules meet texts by an index of grams: a keyword is filed under the one of its pairs of letters that stands in the
fewest texts (or under its only letter), every distinct text of a scope emits each of its pairs once, and where they meet
the text is searched for the keyword. Below `few_rules` rules (counted) the rules are
broadcast and tested directly; up to DIRECT_RULES are tested on each row in their order, which moves no rows at all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallybrook.functions.money import ANY, IN, OUT, direction_of

# The fields that a rule's scope covers, and how far a hit in a field is trusted.
SCOPES = {"对手名称": ["opp_name"], "银行备注": ["memo"], "账户方附言": ["note"], "摘要或备注": ["memo", "note"], "通用": ["opp_name", "memo", "note"]}
FIELD_NAMES = {"opp_name": "对手名称", "memo": "银行备注", "note": "账户方附言"}
CONFIDENCE = {"对手名称": 0.9, "银行备注": 0.78, "账户方附言": 0.72}
# Labels and source of rows with a rule and of rows without one.
BY_RULE = "规则库"
NO_RULE = {"source": "兜底", "confidence": 0.3, "label_1": "其他类", "label_2": "其他", "income": "其他收入", "expense": "其他支出"}
TEXTS = ["opp_name", "memo", "note"]
#: So many rules at most are conditions of one expression.
DIRECT_RULES = 50
RULES = "rule_id string, direction string, scope string, keyword string, excludes array<string>, opp_any array<string>, label_1 string, label_2 string, label_3 string, priority double, rule_seq long"


def _scoped(fields: list[str]) -> Column:
    return F.concat(*fields) if len(fields) > 1 else F.col(fields[0])


def _clean(column: str) -> Column:
    c = F.coalesce(column, F.lit(""))
    return F.when((F.octet_length(c) == 3) & (F.lower(c) == "nan"), "").otherwise(c)  # lower case only where it may matter


def _hit_field(scope: Column, keyword: Column, before: str = "") -> Column:
    """The first field of the scope that holds the keyword, else the scope's first field."""
    out = None
    for name, fields in SCOPES.items():
        pick = reduce(lambda rest, f: F.when(F.col(f"{before}{f}").contains(keyword), FIELD_NAMES[f]).otherwise(rest), reversed(fields), F.lit(FIELD_NAMES[fields[0]]))
        out = F.when(scope == name, pick) if out is None else out.when(scope == name, pick)
    return out


def _grams(text: str, n: int) -> Column:
    """The distinct runs of n letters of a text."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(F.col(text), i, n)))


def _index(scoped: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rules with the gram that they are filed under, and the texts with their grams. A rule whose grams don't all
    stand in texts fits none and is left out."""
    short = rules.where(F.length("keyword") == 1).limit(1).count() > 0  # only then single letters are grams too
    of_text = F.when(F.length("text") > 1, _grams("text", 2)).otherwise(F.array().cast("array<string>"))
    grams = scoped.withColumn("gram", F.explode(F.concat(of_text, _grams("text", 1)) if short else of_text))
    seen = grams.groupBy("scope", "gram").agg(F.count("*").alias("texts"))
    of_rule = F.when(F.length("keyword") > 1, _grams("keyword", 2)).otherwise(F.array("keyword"))
    own = rules.withColumn("grams", of_rule).withColumn("gram", F.explode("grams")).join(seen, ["scope", "gram"])
    rarest = own.groupBy("scope", "rule_seq").agg(F.min_by("gram", F.struct("texts", "gram")).alias("gram"), F.count("*").alias("found"))
    return rules.join(rarest, ["scope", "rule_seq"]).where(F.col("found") == F.size(of_rule)).drop("found"), grams


def _hits(rows: DataFrame, rules: DataFrame, few: bool) -> DataFrame:
    """Rows with scope and text, and each rule of the scope whose keyword stands in the text."""
    if few:
        return rows.join(F.broadcast(rules), "scope").where(F.col("text").contains(F.col("keyword")))
    filed, grams = _index(rows, rules.where("keyword != ''"))
    indexed = grams.join(filed, ["scope", "gram"]).where(F.col("text").contains(F.col("keyword"))).drop("gram")
    return indexed.unionByName(rows.join(rules.where("keyword = ''"), "scope"), allowMissingColumns=True)


def _scoped_rules(rules: DataFrame) -> DataFrame:
    return rules.withColumn("scope", F.when(F.col("scope").isin(*SCOPES), F.col("scope")).otherwise(ANY))


def match_rules(texts: DataFrame, rules: DataFrame, few_rules: int = 500) -> DataFrame:
    """texts(direction, opp_name, memo, note; distinct, none null) with the columns of the best rule: highest priority,
    then rule order. An empty keyword stands in every text, a null one in none. Rules of an unknown scope cover all fields; rules of an unknown direction fit all."""
    rules = _scoped_rules(rules).withColumn("for", F.when(F.col("direction").isin(IN, OUT), F.col("direction")).otherwise(ANY)).drop("direction")
    # only scopes that the rules use
    used = {r["scope"] for r in rules.select("scope").distinct().collect()}
    if not used:
        return texts.where("false").select("direction", *TEXTS, F.lit(None).cast("struct<rule_id:string,keyword:string,scope:string,label_1:string,label_2:string,label_3:string>").alias("rule"), F.lit(None).cast("string").alias("hit_field"))
    scoped = texts.select("direction", *TEXTS, F.explode(F.array(*(F.struct(F.lit(s).alias("scope"), _scoped(f).alias("text")) for s, f in SCOPES.items() if s in used))).alias("x")).select("direction", *TEXTS, "x.scope", "x.text").where("text != ''")
    order, chosen = F.struct(-F.col("priority"), "rule_seq"), F.struct("rule_id", "keyword", "scope", "label_1", "label_2", "label_3")
    few = rules.count() <= few_rules
    fits = ((F.col("for") == ANY) | (F.col("for") == F.col("direction"))) & ~F.exists("excludes", lambda x: F.col("text").contains(x))

    def best(rows: DataFrame, some: DataFrame, fits: Column, by: list[str]) -> DataFrame:
        return _hits(rows, some, few).where(fits).groupBy(*by).agg(F.min_by(F.struct(chosen.alias("rule"), order.alias("order")), order).alias("x"))

    # rules that don't look at the counterparty are decided once for each text of a scope
    by_text = ["direction", "scope", "text"]
    plain = best(scoped.select(*by_text).distinct(), rules.where(F.size("opp_any") == 0), fits, by_text)
    found = scoped.join(plain, by_text).select("direction", *TEXTS, "x")
    of_opp = rules.where(F.size("opp_any") > 0)
    if not of_opp.isEmpty():
        found = found.unionByName(best(scoped, of_opp, fits & F.exists("opp_any", lambda x: F.col("opp_name").contains(x)), ["direction", *TEXTS]))
    return found.groupBy("direction", *TEXTS).agg(F.min_by("x.rule", "x.order").alias("rule")).withColumn("hit_field", _hit_field(F.col("rule.scope"), F.col("rule.keyword")))


CHOSEN = ["rule_id", "keyword", "scope", "label_1", "label_2", "label_3"]


def _fits(rule: Row) -> Column:
    """Whether a rule fits the row, whose cleaned texts stand in _opp_name, _memo and _note."""
    text = _scoped([f"_{f}" for f in SCOPES[rule["scope"]]])
    out = (text != "") & text.contains(F.lit(rule["keyword"]))
    for word in rule["excludes"]:
        out = out & ~text.contains(F.lit(word))
    if rule["opp_any"]:
        out = out & reduce(lambda a, b: a | b, (F.col("_opp_name").contains(F.lit(w)) for w in rule["opp_any"]))
    # last, as few rows come here: a filter on the rule repeats the direction's expression
    return out & (F.col("direction") == rule["direction"]) if rule["direction"] in (IN, OUT) else out


def _tested(rows: DataFrame, rules: list[Row]) -> DataFrame:
    """rows with rule and hit_field: the first of the rules, which come in their order, that fits."""
    kind = "struct<{}>".format(", ".join(f"{c}:string" for c in CHOSEN))
    lists = [r for r in rules if r["excludes"] is not None and r["opp_any"] is not None and r["keyword"] is not None]
    if not lists:
        return rows.withColumns({"rule": F.lit(None).cast(kind), "hit_field": F.lit(None).cast("string")})
    nth = reduce(lambda rest, k: F.when(_fits(lists[k]), k).otherwise(rest), reversed(range(len(lists))), F.lit(None).cast("int"))
    table = F.array(*(F.struct(*(F.lit(r[c]).cast("string").alias(c) for c in CHOSEN)) for r in lists))
    found = rows.withColumn("_nth", nth).withColumn("rule", F.get(table, F.col("_nth")).cast(kind)).drop("_nth")
    return found.withColumn("hit_field", _hit_field(F.col("rule.scope"), F.col("rule.keyword"), "_"))


def tag(ledger: DataFrame, rules: DataFrame, few_rules: int = 500) -> DataFrame:
    """The ledger with direction, label_1 to label_3, label_source, label_confidence, rule_id, keyword, hit_field."""
    clean = {f"_{c}": _clean(c) for c in TEXTS}
    rows = ledger.withColumn("direction", direction_of(F.col("income"), F.col("expense"))).withColumns(clean)
    most = min(few_rules, DIRECT_RULES)
    ordered = _scoped_rules(rules).orderBy(-F.col("priority"), "rule_seq").limit(most + 1).collect() if most else []
    if most and len(ordered) <= most:
        return _labelled(_tested(rows, ordered)).drop("rule", *clean)
    texts = rows.select("direction", *(F.col(f"_{c}").alias(c) for c in TEXTS)).distinct()
    hits = match_rules(texts, rules, few_rules).select(F.col("direction").alias("_d"), *(F.col(c).alias(f"__{c}") for c in TEXTS), "rule", "hit_field")
    on = reduce(lambda a, b: a & b, (F.col(f"_{c}") == F.col(f"__{c}") for c in TEXTS), F.col("direction") == F.col("_d"))
    return _labelled(rows.join(hits, on, "left")).drop("rule", "_d", *clean, *(f"__{c}" for c in TEXTS))


def _labelled(found: DataFrame) -> DataFrame:
    """Rows with the labels of their rule, or the fallback's."""
    hit = F.col("rule").isNotNull()
    trust = reduce(lambda rest, kv: F.when(F.col("hit_field") == kv[0], kv[1]).otherwise(rest), CONFIDENCE.items(), F.lit(None).cast("double"))
    fallback = F.when(F.col("direction") == OUT, NO_RULE["expense"]).otherwise(NO_RULE["income"])
    return found.withColumns({
        "label_1": F.when(hit, F.col("rule.label_1")).otherwise(NO_RULE["label_1"]), "label_2": F.when(hit, F.col("rule.label_2")).otherwise(NO_RULE["label_2"]), "label_3": F.when(hit, F.col("rule.label_3")).otherwise(fallback),
        "label_source": F.when(hit, BY_RULE).otherwise(NO_RULE["source"]), "label_confidence": F.when(hit, trust).otherwise(NO_RULE["confidence"]),
        "rule_id": F.col("rule.rule_id"), "keyword": F.col("rule.keyword"),
    })


def _sums() -> list[Column]:
    return [F.count("*").alias("rows"), F.bround(F.sum(F.coalesce("income", F.lit(0.0))), 2).alias("income"), F.bround(F.sum(F.coalesce("expense", F.lit(0.0))), 2).alias("expense")]


def tag_summary(tagged: DataFrame) -> DataFrame:
    """Rows and amounts by direction and labels; blank labels are kept."""
    labels = ["label_1", "label_2", "label_3"]
    return tagged.groupBy("direction", *(F.coalesce(c, F.lit("")).alias(c) for c in labels)).agg(*_sums())


def tag_distribution(tagged: DataFrame, top: int = 40) -> DataFrame:
    labels = ["label_1", "label_2", "label_3"]
    return tagged.groupBy(*(F.coalesce(c, F.lit("")).alias(c) for c in labels)).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), *labels).limit(top)


def label_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("label_1").agg(F.count("*").alias("rows"), F.count("rule_id").alias("hits"))


def hit_rate(tagged: DataFrame) -> DataFrame:
    """One row: rows, hits, hit_rate (three decimals), and hits by field."""
    by_field = [F.count_if(F.col("hit_field") == f).alias(f"hits_{c}") for c, f in FIELD_NAMES.items()]
    return tagged.agg(F.count("*").alias("rows"), F.count("rule_id").alias("hits"), F.bround(F.count("rule_id") / F.count("*"), 3).alias("hit_rate"), *by_field)


def suggestions(tagged: DataFrame, top: int = 40, least: int = 5) -> DataFrame:
    """Counterparties of rows without a rule: the `top` most frequent, of those the ones with `least` rows, numbered;
    ties go to the first seen."""
    is_open = F.col("rule_id").isNull()  # counted, not filtered by, so that each row's rule is found once
    groups = tagged.where(F.coalesce("opp_name", F.lit("")) != "").groupBy("direction", "opp_name").agg(F.count_if(is_open).alias("rows"), F.min(F.when(is_open, F.col("seq"))).alias("first_seq"))
    found = groups.where("rows > 0").orderBy(F.desc("rows"), "first_seq").limit(top)
    number = F.format_string("NEW-%03d", F.row_number().over(Window.orderBy(F.desc("rows"), "first_seq")))  # `top` rows at most
    return found.where(F.col("rows") >= least).withColumn("suggestion_id", number)
