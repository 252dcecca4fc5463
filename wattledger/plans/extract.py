"""Source tables to landing tables, each as one plan over all services.

Where an extract is driven by the result of another one, the driving keys enter as a
DataFrame and become a semi join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amounts, codes, dates, texts
from ..operators import groups, joins, series, sets
from ..settings import DEFAULTS, Settings

# Fixed values of the source system.
READ_OK = "F"
LOSS_METHOD = 17
INVOICE_KIND = 66
INVOICE_PROGRAMS = (5, 97)
INVOICE_PENDING = "P"
INVESTIGATION_TASKS = (747, 748, 749, 750, 751, 752, 764, 767, 768, 769, 770, 778, 781,
                       803, 804, 805, 807, 10037)
LOSS_STATES = {"R": "EN INSPECCION", "E": "EXCLUIDO", "F": "FRAUDE CONFIRMADO",
               "N": "FRAUDE NO DETECTADO", "P": "PENDIENTE"}
LOSS_STATE_OTHER = "DESCONOCIDO"
BILLABLE = {"S": "FACTURABLE", "N": "NO FACTURABLE"}
BILLABLE_OTHER = "DESCONOCIDO"
ANALYST_REVIEW = "REVISION ANALISTA"
STATE_BEFORE_CLOSE, STATE_CLOSED = 5, 8


def period_lookup(use_periods: DataFrame, bill_windows: DataFrame) -> DataFrame:
    """Consumption periods with the billing window of their cycle that holds their end."""
    windows = bill_windows.select(
        "bill_period", F.col("cycle").alias("__cycle"), F.col("year").alias("bill_year"),
        F.col("month").alias("bill_month"), F.col("starts").alias("window_start"),
        F.col("ends").alias("window_end"))
    return joins.inside(use_periods, windows, {"cycle": "__cycle"}, "ends", "window_start",
                        "window_end").drop("__cycle")


def first_periods(windows: DataFrame, by: list[str]) -> DataFrame:
    """One row per billing period (or other columns ``by``): the smallest period, start and end of its windows."""
    return windows.groupBy(*by).agg(*[F.min(c).alias(c) for c in ("period", "starts", "ends")])


def analysed_cells(use_lines: DataFrame, reading_lines: DataFrame, use_periods: DataFrame,
                   bill_windows: DataFrame, settings: Settings = DEFAULTS, dated_periods: DataFrame | None = None) -> DataFrame:
    """(service, period, type) cells of the last analysed period ends of each service.

    ``dated_periods`` is the :func:`period_lookup` of the two tables, where it is at hand.
    """
    keys = ["service", "period", "kind"]
    seen = sets.union_distinct(
        use_lines.where(F.col("method") == settings["billed_method"]).select(*keys),
        reading_lines.where(F.col("status") == READ_OK).select(*keys))
    dated = seen.join(period_lookup(use_periods, bill_windows) if dated_periods is None else dated_periods, "period")
    return series.last_distinct(dated, "service", "ends", settings["analysed_periods"])


def readings(cells: DataFrame, use_lines: DataFrame, reading_lines: DataFrame,
             devices: DataFrame, kinds: DataFrame, notes: DataFrame,
             settings: Settings = DEFAULTS, loss_lines: DataFrame | None = None) -> DataFrame:
    """Readings and billed use of the analysed cells, side by side per device.

    The cell is matched on the keys of the full outer join, which are filled from either
    side; comparing with each side by OR would compare every pair of rows. ``loss_lines`` has the
    lines in which losses are counted, where ``use_lines`` holds those of the cells only.
    """
    keys = ["service", "period", "kind", "device_id"]
    read = reading_lines.where(F.col("status") == READ_OK).drop("status")
    billed = (use_lines.where(F.col("method") == settings["billed_method"])
              .groupBy(*keys).agg(F.sum("amount").alias("billed_use")))
    both = joins.both_sides(read, billed, keys)
    losses = ((use_lines if loss_lines is None else loss_lines).where(F.col("method") == LOSS_METHOD)
              .groupBy("service", "kind", "bill_period").agg(F.count(F.lit(1)).alias("__losses")))
    rows = (cells.join(losses, ["service", "kind", "bill_period"], "left")
            .join(both, ["service", "period", "kind"]))
    rows = joins.lookup(rows, kinds, {"kind": "code"}, {"text": "__kind"})
    rows = joins.lookup(rows, devices, {"device_id": "id"},
                        {"device": "device", "digits": "digits", "factor": "factor"})
    for i in (1, 2, 3):
        rows = joins.lookup(rows, notes, {f"note_code_{i}": "code"}, {"text": f"__note_{i}"})
    advance = F.col("current_reading") - F.col("previous_reading")
    return rows.select(
        "service", "period", "bill_period",
        dates.day_text("starts").alias("period_start"), dates.day_text("ends").alias("period_end"),
        dates.days_rounded("starts", "ends").alias("days"),
        with_text("kind", "__kind").alias("kind_text"), "kind", "device", "factor", "digits",
        "previous_reading", "current_reading", (advance * F.col("read_factor")).alias("computed_use"),
        "billed_use", "low_limit", "high_limit",
        *[with_text(f"note_code_{i}", f"__note_{i}").alias(f"note_{i}") for i in (1, 2, 3)],
        amounts.zero_as_null(F.coalesce(F.col("__losses"), F.lit(0))).alias("loss_mark"),
        "bill_year", "bill_month", "cycle")


def with_text(code: str, text: str):
    """``code-text`` where the text was found."""
    return F.when(F.col(text).isNotNull(), codes.glue(code, F.lit("-"), text))


def consumption(use_lines: DataFrame, cells: DataFrame | None, routes: DataFrame, use_periods: DataFrame,
                bill_windows: DataFrame, methods: DataFrame, kinds: DataFrame,
                ratings: DataFrame) -> DataFrame:
    """Consumption lines of the given (service, period) keys, of every method and type; all lines without keys.

    ``routes`` has the operating cycle of a service, where it has one.
    """
    rows = use_lines if cells is None else joins.keep_keys(use_lines, cells, ["service", "period"])
    rows = joins.lookup(rows, routes, {"service": "service"}, {"route_cycle": "route_cycle"})
    return decorate_use(rows, use_periods, bill_windows, methods, kinds, ratings, ["route_cycle"])


def decorate_use(rows: DataFrame, use_periods: DataFrame, bill_windows: DataFrame,
                 methods: DataFrame, kinds: DataFrame, ratings: DataFrame,
                 more: list[str] | None = None) -> DataFrame:
    """Names and dates beside consumption lines; a period without a master row is not shown."""
    rows = joins.lookup(rows, bill_windows, {"bill_period": "bill_period"},
                        {"year": "bill_year", "month": "bill_month", "cycle": "cycle"})
    rows = joins.lookup(rows, use_periods, {"period": "period"},
                        {"period": "__period", "starts": "__starts", "ends": "__ends"})
    for names, code, text in ((methods, "method", "__method"), (kinds, "kind", "__kind"),
                              (ratings, "rating_code", "__rating")):
        rows = joins.lookup(rows, names, {code: "code"}, {"text": text})
    return rows.select(
        "service", F.col("__period").alias("period"), "bill_period", "bill_year", "bill_month", "cycle", *(more or []),
        dates.day_text("recorded_at").alias("recorded_on"),
        with_text("method", "__method").alias("method"),
        with_text("kind", "__kind").alias("kind_text"),
        "amount", "calc_function", with_text("rating_code", "__rating").alias("rating"),
        dates.day_text("__starts").alias("period_start"), dates.day_text("__ends").alias("period_end"))


def contract_consumption(use_lines: DataFrame, services: DataFrame, open_orders: DataFrame,
                         as_of: date, *names: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Recent consumption of every service that shares a contract with an open order.

    Siblings are found by contract, not by premises, which would bring in other customers.
    """
    members = joins.siblings(services.select("service", "contract"), open_orders, "service", "contract")
    return recent_consumption(joins.keep_keys(use_lines, members, ["service"]), as_of, *names, settings=settings)


def recent_consumption(use_lines: DataFrame, as_of: date, *names: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The lines of the last months, in the layout of the contract's consumption."""
    recent = use_lines.where(dates.since_months("recorded_at", as_of, settings["history_months"]))
    return decorate_use(recent, *names).drop("cycle", "calc_function")


def balances(bills: DataFrame, as_of: date) -> DataFrame:
    """Open balance, overdue bills and overdue balance per service."""
    open_ = F.col("pending") > 0
    overdue = open_ & (F.col("due_at") < F.lit(as_of))
    return bills.groupBy("service").agg(
        groups.sum_where(open_, "pending").alias("pending_balance"),
        groups.count_where(overdue).alias("overdue_bills"),
        groups.sum_where(overdue, "pending").alias("overdue_balance"))


def services(subscriptions: DataFrame, premises: DataFrame, customers: DataFrame,
             frequencies: DataFrame, bills: DataFrame, billable: DataFrame, names: dict[str, DataFrame],
             as_of: date, premises_keys: DataFrame | None = None) -> DataFrame:
    """Service master: inner chain to premises and customer, lookups and balances beside it.

    ``names`` holds the lookup tables (code, text) of product, cutoff, category and plan, and that of
    subcategory, whose key is (category_code, code).
    """
    rows = subscriptions
    if premises_keys is not None:
        rows = joins.keep_keys(rows, premises_keys, ["premises"])
    rows = rows.join(premises, "premises").join(customers, "customer_id")
    newest = series.latest(frequencies, ["service"], ["recorded_at", "id"], ["frequency"])
    rows = rows.join(newest, "service", "left").join(balances(bills, as_of), "service", "left")
    for name, code, out in (("product", "product_code", "__product"), ("cutoff", "cutoff_code", "__cutoff"),
                            ("category", "category_code", "__category"), ("plan", "plan_code", "__plan"),
                            ("plan", "product_plan_code", "__product_plan")):
        rows = joins.lookup(rows, names[name], {code: "code"}, {"text": out})
    rows = joins.lookup(rows, names["subcategory"], {"category_code": "category_code", "subcategory_code": "code"},
                        {"text": "__subcategory"})
    rows = joins.lookup(rows, billable, {"cutoff_code": "cutoff_code", "product_code": "product_code"},
                        {"billable": "billable"})
    return rows.select(
        "service", "contract", "premises", with_text("product_code", "__product").alias("product"),
        dates.day_text("installed_at").alias("installed_on"), dates.day_text("withdrawn_at").alias("withdrawn_on"),
        "frequency", with_text("cutoff_code", "__cutoff").alias("cutoff_state"),
        with_text("category_code", "__category").alias("category"),
        with_text("subcategory_code", "__subcategory").alias("subcategory"), "cycle",
        with_text("plan_code", "__plan").alias("plan"), with_text("product_plan_code", "__product_plan").alias("product_plan"),
        codes.glue("first_name", F.lit(" "), "last_name").alias("customer"), "customer_document", "town", "address", "page",
        "pending_balance", F.coalesce("overdue_bills", F.lit(0)).alias("overdue_bills"), "overdue_balance", "billable",
        F.when(F.col("billable").isNotNull(),
               codes.glue("billable", F.lit("-"),
                          codes.status_text("billable", BILLABLE, BILLABLE_OTHER))).alias("billable_text"))


def open_orders(orders: DataFrame, activities: DataFrame, subscriptions: DataFrame, activity_names: DataFrame,
                state_names: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Activities of the quality task whose order is neither cancelled nor closed."""
    live = orders.where((F.col("state") != settings["cancelled_state"]) & F.col("closed_at").isNull())
    mine = activities.where(F.col("task") == settings["quality_task"])
    rows = mine.join(joins.merged(live.select("order", "state", "created_at")), "order")
    rows = joins.lookup(rows, subscriptions, {"service": "service"}, {"premises": "premises"})
    rows = joins.lookup(rows, activity_names, {"activity": "code"}, {"text": "__activity"})
    rows = joins.lookup(rows, state_names, {"state": "code"}, {"text": "__state"})
    known = F.when(F.col("__activity").isNotNull(), F.col("activity"))
    return rows.select("order", "service", "premises", "contract", "created_at",
                       codes.glue(known, F.lit(" - "), "__activity").alias("activity"),
                       codes.glue("state", F.lit(" - "), "__state").alias("order_state"), "order_comment")


def bills(accounts: DataFrame, invoices: DataFrame, bill_windows: DataFrame,
          use_periods: DataFrame, charge_lines: DataFrame,
          settings: Settings = DEFAULTS) -> DataFrame:
    """The last analysed bills of each service, own and recovered amounts apart."""
    return with_amounts(last_bills(accounts, invoices, bill_windows, use_periods, settings), charge_lines)


def last_bills(accounts: DataFrame, invoices: DataFrame, bill_windows: DataFrame, use_periods: DataFrame,
               settings: Settings = DEFAULTS) -> DataFrame:
    """The last analysed bills of each service with their periods."""
    wanted = (F.col("invoice_kind") == INVOICE_KIND) | (
        F.col("program").isin(*INVOICE_PROGRAMS) & (F.col("state") == INVOICE_PENDING))
    windows = bill_windows.select("bill_period", F.col("year").alias("bill_year"),
                                  F.col("month").alias("bill_month"), F.col("cycle"),
                                  F.col("ends").alias("__window_end"), "period")
    periods = use_periods.select("period", F.col("cycle"), "starts", F.col("ends").alias("__ends"))
    rows = (accounts.join(joins.merged(invoices), "invoice").where(wanted)
            .join(windows, "bill_period").join(periods, ["period", "cycle"]))
    return series.last_rows(rows, ["service"],
                            [F.col("__window_end").desc(), F.col("bill").desc()],
                            settings["analysed_periods"])


def with_amounts(latest: DataFrame, charge_lines: DataFrame) -> DataFrame:
    """:func:`last_bills` in the layout of the extract, with their own and recovered amounts."""
    split = own_and_recovered(charge_lines, latest.select("service", "bill", "bill_period", "period"))
    return latest.join(split, "bill", "left").select(
        "service", "bill", "bill_period", "bill_year", "bill_month", "paid_at", "total", "paid",
        "claimed", "pending", dates.day_text("due_at").alias("due_on"), "own_amount",
        "recovered_amount", "period", dates.day_text("starts").alias("period_start"),
        dates.day_text("__ends").alias("period_end"))


def own_and_recovered(charge_lines: DataFrame, bills: DataFrame) -> DataFrame:
    """Signed charges of each bill, split by whether their period is that of the bill.

    Lines meet their bills first: a bill has few lines, so sums by bill and period would be about as many
    as the lines, and a task would hold them all at once.
    """
    key = ["service", "bill", "bill_period"]
    signed = charge_lines.select(*key, F.col("period").alias("__period"), amounts.debit_or_credit("sign", "amount").alias("__signed"))
    met = signed.join(joins.merged(bills), key)
    own = F.coalesce(F.col("__period"), F.col("period"))
    return met.groupBy("bill").agg(
        groups.sum_where(own == F.col("period"), "__signed").alias("own_amount"),
        groups.sum_where(own != F.col("period"), "__signed").alias("recovered_amount"))


def charges(lines: DataFrame, accounts: DataFrame, invoices: DataFrame, bill_windows: DataFrame,
            use_periods: DataFrame, concepts: DataFrame, causes: DataFrame,
            programs: DataFrame) -> DataFrame:
    """Charge lines with the billing period of their bill and named codes.

    A bill brings year and month of its period with it, so a line meets its bill once; what its own period is
    called and when it runs it looks up in two small tables.
    """
    billed = accounts.select("bill", "invoice").join(joins.merged(invoices.select("invoice", "bill_period")), "invoice")
    billed = joins.lookup(billed, bill_windows, {"bill_period": "bill_period"}, {"year": "bill_year", "month": "bill_month"}).drop("invoice")
    rows = lines.join(joins.merged(billed), "bill", "left")
    rows = joins.lookup(rows, bill_windows, {"period": "period"}, {"year": "__year", "month": "__month"})
    rows = joins.lookup(rows, use_periods, {"period": "period"}, {"starts": "__starts", "ends": "__ends"})
    rows = joins.lookup(rows, concepts, {"concept_code": "code"}, {"text": "__concept"})
    rows = joins.lookup(rows, causes, {"cause_code": "code"}, {"text": "__cause"})
    rows = joins.lookup(rows, programs, {"program_code": "code"}, {"text": "__program"})
    return rows.select(
        "service", "bill", "bill_period", "period",
        with_text("concept_code", "__concept").alias("concept"),
        F.when(F.col("__cause").isNotNull(),
               codes.bare_code("cause_code", "__cause")).alias("cause"),
        "sign", dates.year_month("__year", "__month").alias("period_label"), "document",
        dates.time_text("created_at").alias("created_at"),
        with_text("program_code", "__program").alias("program"), "tariff",
        amounts.default("units", 1.0).alias("units"), "amount",
        dates.day_text("__starts").alias("period_start"), dates.day_text("__ends").alias("period_end"),
        "bill_year", "bill_month")


def requests(packages: DataFrame, motives: DataFrame, kinds: DataFrame, states: DataFrame,
             channels: DataFrame, people: DataFrame, areas: DataFrame, customers: DataFrame,
             keys: DataFrame | None = None) -> DataFrame:
    """Requests of the services: kind and state must exist, the other names may not."""
    mine = motives if keys is None else joins.keep_keys(motives, keys, ["service"])
    rows = mine.select("service", "request").join(joins.merged(packages), "request")
    rows = (rows.join(kinds.select(F.col("code").alias("kind_code"), F.col("text").alias("__kind")), "kind_code")
            .join(states.select(F.col("code").alias("state_code"), F.col("text").alias("__state")), "state_code"))
    rows = joins.lookup(rows, channels, {"channel_code": "code"}, {"text": "__channel"})
    rows = joins.lookup(rows, people, {"person_code": "code"}, {"text": "__person"})
    rows = joins.lookup(rows, areas, {"area_code": "code"}, {"text": "__area"})
    rows = joins.lookup(rows, customers, {"customer_id": "customer_id"},
                        {"first_name": "__first", "last_name": "__last"})
    dash = F.lit(" - ")
    return rows.select(
        "service", "request", codes.glue("__first", F.lit(" "), "__last").alias("customer"),
        codes.glue("kind_code", dash, "__kind").alias("request_kind"), "requested_at",
        codes.glue("state_code", dash, "__state").alias("request_state"), "attended_at",
        F.col("comment"), codes.glue("channel_code", dash, "__channel").alias("channel"),
        codes.glue("person_code", dash, "__person").alias("analyst"),
        codes.glue("area_code", dash, "__area").alias("area"))


def investigations(cases: DataFrame, kinds: DataFrame, state_names: DataFrame,
                   use_periods: DataFrame, as_of: date, settings: Settings = DEFAULTS) -> DataFrame:
    rows = cases.where(dates.since_months("recorded_at", as_of, settings["history_months"]))
    rows = joins.lookup(rows, kinds, {"kind": "code"}, {"text": "__kind"})
    rows = joins.lookup(rows, state_names, {"state": "code"}, {"text": "__state"})
    rows = joins.lookup(rows, use_periods, {"period": "period"}, {"starts": "__starts", "ends": "__ends"})
    return rows.select(
        "service", with_text("kind", "__kind").alias("kind_text"), "period", "request", "state",
        with_text("state", "__state").alias("state_text"),
        dates.time_text("recorded_at").alias("recorded_at"),
        dates.day_text("__starts").alias("period_start"), dates.day_text("__ends").alias("period_end"))


def loss_files(files: DataFrame, irregularities: DataFrame) -> DataFrame:
    """Loss files; a file without a known irregularity shows the bare separator."""
    rows = joins.lookup(files, irregularities, {"irregularity_code": "code"}, {"text": "__irregularity"})
    known = F.when(F.col("__irregularity").isNotNull(), F.col("irregularity_code"))
    return rows.select(
        "service", "loss_file", "state",
        codes.glue(known, F.lit("-"), "__irregularity").alias("irregularity"), "request",
        dates.time_text("recorded_at").alias("recorded_at"),
        dates.day_text("fraud_from").alias("fraud_start"), dates.day_text("fraud_to").alias("fraud_end"),
        "order", "comment",
        codes.glue("state", F.lit("-"),
                   codes.status_text("state", LOSS_STATES, LOSS_STATE_OTHER)).alias("state_text"))


def closers(changes: DataFrame, people: DataFrame, users: DataFrame) -> DataFrame:
    """Who moved each order to closed; one name per order, the latest change decides."""
    moved = changes.where((F.col("from_state") == STATE_BEFORE_CLOSE)
                          & (F.col("to_state") == STATE_CLOSED))
    known = moved.join(users.select("user", "user_id"), "user").join(people, "user_id")
    return (series.latest(known, ["order"], ["changed_at", "user_id"], ["name"])
            .withColumnRenamed("name", "closed_by"))


def review_orders(drivers: DataFrame, criticals: DataFrame, cases: DataFrame, orders: DataFrame,
                  activities: DataFrame, closed_by: DataFrame, use_periods: DataFrame,
                  names: dict[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """Review orders of the driving (service, billing period, type) keys, from four sources.

    ``drivers`` carries the period and window of the billing period; a driver without a period matches
    every period of its service and type. A service has few drivers by meaning (the analysed periods),
    and every source meets them once: by its period, or for cases by the window of their day, or for
    decisions by the day of their order. What names an activity (a critical by its reference, cases by their
    request) is reduced to the distinct cells that are driven before activities meet it, so repeated rows
    multiply nothing. Orders and who closed them are met by order, and only by the activities that are left then;
    a decision needs the day of its order first. The result has no repeated rows. ``names`` holds the
    lookup tables (code, text) of task, activity, kind and state.
    """
    critical, case = F.lit("critical"), F.lit("case")
    spans = joins.distinct_apart(drivers.select(*[F.col(c).alias(f"d_{c}") for c in ("service", "kind", "period")], "window_start", "window_end"))
    sources = criticals.select(critical.alias("source"), "service", "kind", "period", F.col("activity_ref").alias("ref"),
                               F.lit(None).cast("timestamp").alias("recorded_at")).unionByName(
        cases.select(case.alias("source"), "service", "kind", "period", F.col("request").alias("ref"), "recorded_at"))
    by_period = F.col("period").isNotNull() & (F.col("d_period").isNull() | (F.col("d_period") == F.col("period")))
    wanted = F.coalesce(by_period, F.lit(False)) | F.col("recorded_at").between(F.col("window_start"), F.col("window_end"))
    cell = (F.col("service") == F.col("d_service")) & (F.col("kind") == F.col("d_kind"))
    named = sources.join(joins.merged(spans), cell & wanted, "left_semi").select("source", "service", "ref", "kind", "period").distinct()

    serves = F.array_compact(F.array(
        F.when(F.col("activity") == settings["review_activity"], F.struct(critical.alias("source"), F.col("activity_ref").alias("ref"))),
        F.when(F.col("task").isin(*INVESTIGATION_TASKS), F.struct(case.alias("source"), F.col("request").alias("ref")))))
    own = ["order", "service", "task", "activity"]
    serving = (F.col("activity") == settings["review_activity"]) | F.col("task").isin(*INVESTIGATION_TASKS)
    tagged = activities.where(serving).select(*own, F.explode(serves).alias("serves")).select(*own, "serves.*")
    found = joins.merged(orders.select("order", "created_at", "closed_at", "state"))
    met = tagged.join(joins.merged(named), ["source", "service", "ref"]).select(
        *own, F.col("kind").cast("bigint").alias("kind"), F.col("period").cast("bigint").alias("period")).join(found, "order")
    # a decision belongs to every period in whose window its order was created
    windows = spans.select("d_service", F.col("d_period").cast("bigint").alias("period"), "window_start", "window_end").distinct()
    # as one value, so Spark asks no more of these orders than of the others and shuffles both as one
    within = F.coalesce(F.col("created_at").between(F.col("window_start"), F.col("window_end")), F.lit(False))
    inside = (F.col("service") == F.col("d_service")) & within
    decided = (activities.where(F.col("activity") == settings["decision_activity"]).select(*own).join(found, "order")
               .join(joins.merged(windows), inside).drop("d_service", "window_start", "window_end"))
    rows = (met.unionByName(decided.withColumn("kind", F.lit(None).cast("bigint")))
            .join(joins.merged(closed_by), "order", "left").distinct())
    rows = joins.lookup(rows, use_periods, {"period": "period"}, {"starts": "__starts", "ends": "__ends"})
    for name in ("task", "activity", "kind", "state"):
        rows = joins.lookup(rows, names[name], {name: "code"}, {"text": f"__{name}"})
    return rows.select("order", "service", "kind", with_text("kind", "__kind").alias("kind_text"), "period",
                       with_text("task", "__task").alias("task"), with_text("activity", "__activity").alias("activity"),
                       dates.time_text("created_at").alias("created_at"),
                       dates.time_text("closed_at").alias("closed_at"), with_text("state", "__state").alias("order_state"), "closed_by",
                       dates.day_text("__starts").alias("period_start"),
                       dates.day_text("__ends").alias("period_end"))


def order_comments(reviews: DataFrame, comments: DataFrame, observations: DataFrame, activities: DataFrame,
                   kind_names: DataFrame, as_of) -> DataFrame:
    """Comments of the review orders, and the observations made while they were open.

    A comment names its order and the code of its kind. Its service is that of an activity of the
    order, the smallest if they differ, NULL without one; the text of a kind that has no name is NULL.
    """
    wanted = sets.distinct_keys(reviews, ["order"])
    served = joins.keep_keys(activities, wanted, ["order"]).groupBy("order").agg(F.min("service").alias("service"))
    own = joins.keep_keys(comments, wanted, ["order"]).join(served, "order", "left")
    own = joins.lookup(own, kind_names, {"kind_code": "code"}, {"text": "comment_kind"}).select(
        "order", "service", "recorded_at", "comment_kind", texts.clean("comment").alias("comment"))
    spans = sets.distinct_keys(
        reviews, ["order", "service", "kind", "period", "opened_at", "ended_at"], ["order"])
    spans = spans.select("order", F.col("service").alias("r_service"), F.col("kind").alias("r_kind"),
                         F.col("period").alias("r_period"), "opened_at", "ended_at")
    told = observations.select("service", "kind", "period", "observed_at", "comment").distinct()
    seen = joins.inside(told, spans,
                        {"service": "r_service", "kind": "r_kind", "period": "r_period"},
                        "observed_at", "opened_at", "ended_at", open_end=F.lit(as_of))
    seen = seen.select("order", "service", F.col("observed_at").alias("recorded_at"),
                       F.lit(ANALYST_REVIEW).alias("comment_kind"),
                       texts.clean("comment").alias("comment")).distinct()
    return own.unionByName(seen)
