"""Declared columns of the landing, history and feature tables.

Inside the library columns have English names. Stored tables keep the names and the order
their readers expect, so a frame is renamed once when it is read and once when it is
published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name in this library, stored name and type of each column, in stored order.
_LANDING = {
    "open_orders": (
        ("order", "id_orden", "bigint"),
        ("service", "servicio_suscrito", "bigint"),
        ("premises", "instalacion", "bigint"),
        ("contract", "contrato", "bigint"),
        ("created_at", "fecha_creacion", "timestamp_ntz"),
        ("activity", "actividad", "string"),
        ("order_state", "estado_orden", "string"),
        ("order_comment", "comentario_orden", "string"),
    ),
    "services": (
        ("service", "servicio_suscrito", "bigint"),
        ("contract", "contrato", "bigint"),
        ("premises", "instalacion", "bigint"),
        ("product", "servicio", "string"),
        ("installed_on", "fecha_instalacion", "string"),
        ("withdrawn_on", "fecha_retiro", "string"),
        ("frequency", "periodicidad", "double"),
        ("cutoff_state", "estado_corte", "string"),
        ("category", "categoria", "string"),
        ("subcategory", "subcategoria", "string"),
        ("cycle", "ciclo", "bigint"),
        ("plan", "plan_facturacion", "string"),
        ("product_plan", "plan_facturacion_pr_product", "string"),
        ("customer", "nombre_cliente", "string"),
        ("customer_document", "identificacion", "string"),
        ("town", "localidad", "string"),
        ("address", "direccion", "string"),
        ("page", "pagina", "string"),
        ("pending_balance", "saldo_pendiente", "double"),
        ("overdue_bills", "cuentas_vencidas", "bigint"),
        ("overdue_balance", "saldo_vencido", "double"),
        ("billable", "estado_corte_facturable", "string"),
        ("billable_text", "estado_corte_facturable_desc", "string"),
    ),
    "readings": (
        ("service", "servicio_suscrito", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
        ("days", "dias_consumo", "bigint"),
        ("kind_text", "tipo_consumo", "string"),
        ("kind", "tipocons", "bigint"),
        ("device", "medidor", "string"),
        ("factor", "constante", "string"),
        ("digits", "digitos_medidor", "bigint"),
        ("previous_reading", "lectura_anterior", "double"),
        ("current_reading", "lectura_actual", "double"),
        ("computed_use", "consumo_calculado", "double"),
        ("billed_use", "consumo_facturado", "double"),
        ("low_limit", "limite_inferior", "double"),
        ("high_limit", "limite_superior", "double"),
        ("note_1", "observacion_lectura", "string"),
        ("note_2", "observacion_lectura_2", "string"),
        ("note_3", "observacion_lectura_3", "int"),
        ("loss_mark", "pno", "string"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("cycle", "ciclo_facturacion", "bigint"),
    ),
    "consumption": (
        ("service", "servicio_suscrito", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("cycle", "ciclo", "bigint"),
        ("route_cycle", "ciclo_operativo", "int"),
        ("recorded_on", "fecha_registro", "string"),
        ("method", "metodo_calculo", "string"),
        ("kind_text", "tipo_consumo", "string"),
        ("amount", "consumo", "double"),
        ("calc_function", "funcion_calculo", "string"),
        ("rating", "calificacion", "string"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
    ),
    "review_orders": (
        ("order", "id_orden", "bigint"),
        ("service", "servicio_suscrito", "bigint"),
        ("kind_text", "tipo_consumo", "string"),
        ("period", "id_periodo_consumo", "bigint"),
        ("task", "tipo_trabajo", "string"),
        ("activity", "actividad", "string"),
        ("created_at", "fecha_creacion_orden", "string"),
        ("closed_at", "fecha_legalizacion_orden", "string"),
        ("order_state", "estado", "string"),
        ("closed_by", "analista_legaliza", "string"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
    ),
    "order_comments": (
        ("order", "id_orden", "bigint"),
        ("service", "servicio_suscrito", "bigint"),
        ("recorded_at", "fecha_registro", "timestamp_ntz"),
        ("comment_kind", "tipo_comentario", "string"),
        ("comment", "comentario", "string"),
    ),
    "bills": (
        ("service", "servicio_suscrito", "bigint"),
        ("bill", "id_cuenta_cobro", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("paid_at", "fecha_pago", "timestamp_ntz"),
        ("total", "valor_total", "double"),
        ("paid", "valor_abonado", "double"),
        ("claimed", "valor_reclamo", "double"),
        ("pending", "valor_pendiente", "double"),
        ("due_on", "fecha_vencimiento", "string"),
        ("own_amount", "valor_periodo", "double"),
        ("recovered_amount", "valor_recuperado", "double"),
        ("period", "id_periodo_consumo", "bigint"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
    ),
    "charges": (
        ("service", "servicio_suscrito", "bigint"),
        ("bill", "id_cuenta_cobro", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("period", "id_periodo_consumo", "double"),
        ("concept", "concepto", "string"),
        ("cause", "causal", "string"),
        ("sign", "signo", "string"),
        ("period_label", "periodo_consumo", "string"),
        ("document", "documento_soporte", "string"),
        ("created_at", "fecha_creacion_cargo", "string"),
        ("program", "programa", "string"),
        ("tariff", "id_tarifa", "double"),
        ("units", "unidades", "double"),
        ("amount", "valor", "double"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
    ),
    "requests": (
        ("service", "servicio_suscrito", "bigint"),
        ("request", "id_solicitud", "bigint"),
        ("customer", "usuario", "string"),
        ("request_kind", "tipo_solicitud", "string"),
        ("requested_at", "fecha_solicitud", "timestamp_ntz"),
        ("request_state", "estado_solicitud", "string"),
        ("attended_at", "fecha_atencion_solicitud", "timestamp_ntz"),
        ("comment", "comentario", "string"),
        ("channel", "medio_recepcion", "string"),
        ("analyst", "analista", "string"),
        ("area", "area_organizacional", "string"),
    ),
    "contract_consumption": (
        ("service", "servicio_suscrito", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("amount", "consumo", "double"),
        ("method", "metodo_calculo", "string"),
        ("kind_text", "tipo_consumo", "string"),
        ("rating", "calificacion", "string"),
        ("recorded_on", "fecha_registro", "string"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
    ),
    "investigations": (
        ("service", "servicio_suscrito", "bigint"),
        ("kind_text", "tipo_consumo", "string"),
        ("period", "id_periodo_consumo", "bigint"),
        ("request", "solicitud_investigacion", "bigint"),
        ("state", "estado_investigacion", "bigint"),
        ("state_text", "estado_investigacion_desc", "string"),
        ("recorded_at", "fecha_registro", "string"),
        ("period_start", "fecha_ini_consumo", "string"),
        ("period_end", "fecha_fin_consumo", "string"),
    ),
    "loss_files": (
        ("service", "servicio_suscrito", "bigint"),
        ("loss_file", "id_pno", "bigint"),
        ("state", "estado_pno", "string"),
        ("irregularity", "tipo_irregularidad", "string"),
        ("request", "id_solicitud", "bigint"),
        ("recorded_at", "fecha_registro", "string"),
        ("fraud_start", "fecha_inicio_fraude", "string"),
        ("fraud_end", "fecha_fin_fraude", "string"),
        ("order", "id_orden", "bigint"),
        ("comment", "comentario", "string"),
        ("state_text", "estado_pno_desc", "string"),
    ),
}

_PUBLISHED = {
    "consumption_history": (
        ("service", "servicio_suscrito", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("kind", "tipo_consumo_cod", "bigint"),
        ("device", "medidor", "string"),
        ("device_unknown", "medidor_desconocido", "boolean"),
        ("kind_text", "tipo_consumo", "string"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("cycle", "ciclo_facturacion", "bigint"),
        ("period_start", "fecha_ini_consumo", "date"),
        ("period_end", "fecha_fin_consumo", "date"),
        ("days", "dias_consumo", "bigint"),
        ("previous_reading", "lectura_anterior", "double"),
        ("current_reading", "lectura_actual", "double"),
        ("computed_use", "consumo_calculado", "double"),
        ("billed_use", "consumo_facturado", "double"),
        ("factor", "constante", "double"),
        ("digits", "digitos_medidor", "bigint"),
        ("low_limit", "limite_inferior", "double"),
        ("high_limit", "limite_superior", "double"),
        ("note_1", "observacion_lectura", "string"),
        ("note_2", "observacion_lectura_2", "string"),
        ("note_3", "observacion_lectura_3", "string"),
        ("loss_mark", "pno", "string"),
        ("period_use", "consumo_facturado_periodo", "double"),
        ("billed_rows", "n_filas_facturado", "bigint"),
        ("rating", "calificacion", "string"),
        ("n_ratings", "n_calificaciones", "bigint"),
        ("ratings", "calificaciones", "array<string>"),
        ("calc_function", "funcion_calculo", "string"),
        ("n_calc_functions", "n_funciones_calculo", "bigint"),
        ("last_recorded_on", "fecha_registro_ultima", "date"),
        ("n_devices", "n_medidores_periodo", "bigint"),
        ("device_use", "consumo_facturado_medidores", "double"),
        ("use_reconciles", "cuadra_consumo_periodo", "boolean"),
        ("grain_rows", "n_filas_grano", "bigint"),
        ("run_id", "run_id", "string"),
        ("loaded_at", "fecha_carga_silver", "timestamp"),
    ),
    "charge_history": (
        ("service", "servicio_suscrito", "bigint"),
        ("bill", "id_cuenta_cobro", "bigint"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("concept", "concepto", "string"),
        ("concept_code", "concepto_cod", "int"),
        ("cause", "causal", "string"),
        ("cause_code", "causal_cod", "int"),
        ("sign", "signo", "string"),
        ("program", "programa", "string"),
        ("program_code", "programa_cod", "int"),
        ("document", "documento_soporte", "string"),
        ("tariff", "id_tarifa", "string"),
        ("period_label", "periodo_consumo_texto", "string"),
        ("created_on", "fecha_creacion_cargo", "date"),
        ("period_start", "fecha_ini_consumo", "date"),
        ("period_end", "fecha_fin_consumo", "date"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("units", "unidades", "double"),
        ("amount", "valor", "double"),
        ("signed_amount", "valor_con_signo", "double"),
        ("account_period", "id_periodo_consumo_cuenta", "bigint"),
        ("account_year", "anio_facturacion_cuenta", "bigint"),
        ("account_month", "mes_facturacion_cuenta", "bigint"),
        ("account_total", "valor_total_cuenta", "double"),
        ("account_pending", "valor_pendiente_cuenta", "double"),
        ("account_own", "valor_periodo_cuenta", "double"),
        ("account_recovered", "valor_recuperado_cuenta", "double"),
        ("account_paid_on", "fecha_pago_cuenta", "date"),
        ("is_regular", "es_facturacion_normal", "boolean"),
        ("is_loss", "es_pno", "boolean"),
        ("has_recovery_token", "documento_tiene_token_recuperacion", "boolean"),
        ("period_differs", "periodo_consumo_difiere_de_cuenta", "boolean"),
        ("is_recovery", "es_recuperacion", "boolean"),
        ("grain_rows", "n_filas_grano", "bigint"),
        ("run_id", "run_id", "string"),
        ("loaded_at", "fecha_carga_silver", "timestamp"),
    ),
    "features": (
        ("service", "servicio_suscrito", "bigint"),
        ("period", "id_periodo_consumo", "bigint"),
        ("kind", "tipo_consumo_cod", "bigint"),
        ("kind_text", "tipo_consumo", "string"),
        ("bill_period", "id_periodo_facturacion", "bigint"),
        ("bill_year", "anio_facturacion", "bigint"),
        ("bill_month", "mes_facturacion", "bigint"),
        ("period_start", "fecha_ini_consumo", "date"),
        ("period_end", "fecha_fin_consumo", "date"),
        ("days", "dias_consumo", "bigint"),
        ("period_use", "consumo_facturado_periodo", "double"),
        ("computed_use", "consumo_calculado", "double"),
        ("n_devices", "n_medidores_periodo", "bigint"),
        ("device_set_changed", "medidor_cambio_detectado_por_serie", "boolean"),
        ("negative_use", "consumo_calculado_negativo", "boolean"),
        ("note_device_change", "tiene_observacion_cambio_medidor", "boolean"),
        ("devices", "medidores", "array<string>"),
        ("charges", "valor_cargos_periodo", "double"),
        ("other_charges", "valor_cargos_programa_anormal", "double"),
        ("measured_units", "unidades_consumo_cobradas", "double"),
        ("unlegalised_units", "unidades_consumo_sin_legalizar", "double"),
        ("charges_delta", "delta_valor_pct", "double"),
        ("units_delta", "delta_unidades_consumo_pct", "double"),
        ("factor", "constante_declarada", "double"),
        ("factor_min", "constante_efectiva_min", "double"),
        ("factor_max", "constante_efectiva_max", "double"),
        ("factor_differs", "constante_efectiva_difiere_entre_tipos", "boolean"),
        ("digits", "digitos_medidor", "bigint"),
        ("lap_ratio", "ratio_vuelta_falsa", "double"),
        ("false_lap", "flag_vuelta_falsa", "boolean"),
        ("reading_fell", "hay_lectura_decreciente", "boolean"),
        ("falling_streak", "n_periodos_lectura_decreciente_consecutivos", "bigint"),
        ("note_lower_reading", "tiene_observacion_lectura_menor", "boolean"),
        ("reconnected_on", "fecha_ultima_reconexion", "date"),
        ("days_since_reconnection", "dias_desde_reconexion", "bigint"),
        ("reconnected_inside", "solicitud_reconexion_intersecta_periodo", "boolean"),
        ("suspended_inside", "solicitud_suspension_intersecta_periodo", "boolean"),
        ("mean_before", "promedio_periodos_previos", "double"),
        ("n_in_mean", "n_periodos_usados_en_promedio", "bigint"),
        ("mean_deviation", "desviacion_vs_promedio_pct", "double"),
        ("exceeded_before", "tuvo_consumo_alto_historico", "boolean"),
        ("n_with_limit_before", "n_periodos_previos_con_limite", "bigint"),
        ("high_limit", "limite_superior", "double"),
        ("exceeds_now", "consumo_supera_limite_actual", "boolean"),
        ("investigated", "flag_investigacion", "boolean"),
        ("has_loss_charge", "tiene_cargo_pno", "boolean"),
        ("has_recovery_charge", "tiene_cargo_recuperacion", "boolean"),
        ("run_id", "run_id", "string"),
        ("loaded_at", "fecha_carga_silver", "timestamp"),
    ),
}

# Words that would make a column a verdict instead of a measure.
VERDICT_WORDS = ("cierre", "sugerid", "recomend", "requiere_", "veredicto", "decision", "accion")


def fields(table: str) -> list[tuple[str, str, str]]:
    """(library name, stored name, type) in stored order."""
    return list(_LANDING.get(table) or _PUBLISHED[table])


def tables() -> list[str]:
    return [*_LANDING, *_PUBLISHED]


def stored_schema(table: str, commented: bool = False) -> T.StructType:
    """Stored names and types in order; with comments, each column has the library's name in words as its comment."""
    return T.StructType.fromDDL(", ".join(f"`{n}` {t}" + (f" COMMENT '{own.replace('_', ' ')}'" if commented else "") for own, n, t in fields(table)))


def check_order(df: DataFrame, wanted: list[str]) -> None:
    """A write by position needs the same names in the same order."""
    found = [c.lower() for c in df.columns]
    missing = [c for c in wanted if c not in found]
    surplus = [c for c in found if c not in wanted]
    if missing or surplus:
        raise ValueError(f"columns differ: missing {missing}, surplus {surplus}")
    if found != wanted:
        at = next(i for i, (a, b) in enumerate(zip(found, wanted)) if a != b)
        raise ValueError(f"column {at} is {found[at]}, expected {wanted[at]}")


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order; values that do not fit become NULL."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def from_landing(df: DataFrame, table: str) -> DataFrame:
    """Stored names to library names, with declared types."""
    return df.select([F.col(stored).try_cast(t).alias(own) for own, stored, t in fields(table)])


def publish(df: DataFrame, table: str, run_id: str | None = None, loaded_at=None) -> DataFrame:
    """Library names to stored names, in stored order."""
    if run_id is not None:
        df = df.withColumn("run_id", F.lit(run_id))
    if loaded_at is not None:
        df = df.withColumn("loaded_at", F.lit(loaded_at))
    return df.select([F.col(own).cast(t).alias(stored) for own, stored, t in fields(table)])


def type_differences(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """(column, declared type, found type) where the two differ or the column is missing."""
    found = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    return [(n, t, found.get(n, "missing")) for _, n, t in fields(table) if found.get(n) != t]


def uncommented(df: DataFrame) -> list[str]:
    """Columns without a comment."""
    return [f.name for f in df.schema if not (f.metadata.get("comment") or "").strip()]


def verdict_columns(columns: list[str], words: tuple[str, ...] = VERDICT_WORDS) -> list[str]:
    return [c for c in columns if any(w in c.lower() for w in words)]
