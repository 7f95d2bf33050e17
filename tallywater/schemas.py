"""Declared tables: columns, sort keys, date partition and column defaults.

Unsigned source widths are widened one step (0-255 fits a short, ids fit a
long) and single-precision floats are kept as doubles, so that a threshold such
as 0.90 means the same number in storage and in a rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

TODAY = "today"


@dataclass(frozen=True)
class Table:
    ddl: str
    sort: tuple[str, ...]
    partition: str | None = None
    defaults: dict[str, object] = field(default_factory=dict)
    bloom: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def default(self, column: str) -> Column:
        value = self.defaults.get(column)
        return F.current_date() if value == TODAY else F.lit(value)


def _drilldown(parent: str) -> Table:
    return Table(
        "measure_id long, department_id long, department_name string, "
        "measure_value decimal(18,4), measure_date date, parent_kpi string",
        ("measure_date", "department_id", "measure_id"),
        defaults={"measure_date": TODAY, "parent_kpi": parent},
    )


# Table and column names, sort keys and defaults.
TABLES: dict[str, Table] = {
    "dim_time": Table(
        "date_id date, full_date date, day short, month short, quarter short, year int",
        ("date_id",),
    ),
    "dim_customer": Table(
        "customer_id long, account_no string, customer_name string, district string, "
        "tariff_category string, customer_segment string",
        ("customer_id",),
        defaults={"customer_segment": "Residential"},
    ),
    "dim_facility": Table(
        "facility_id long, facility_name string, facility_type string, district string, "
        "latitude double, longitude double",
        ("facility_id",),
    ),
    "dim_department": Table(
        "department_id long, department_name string, manager_name string, team_size int",
        ("department_id",),
    ),
    "dim_agent": Table(
        "agent_id long, agent_name string, department_id long, role_title string, "
        "hire_date date, status string",
        ("agent_id",),
        defaults={"status": "Active"},
    ),
    "fact_tickets": Table(
        "ticket_id long, date_id date, customer_id long, facility_id long, department_id long, "
        "agent_id long, issue_category string, issue_channel string, resolution_time_hrs double, "
        "reopened short, resolved_in_first_contact short, satisfaction_score double, "
        "nps_score byte, effort_score double, sla_compliance short, response_time_mins int",
        ("date_id", "ticket_id"),
        partition="date_id",
    ),
    "fact_agent_performance": Table(
        "performance_id long, date_id date, agent_id long, department_id long, "
        "total_tickets_handled int, avg_handle_time_mins double, escalation_rate double, "
        "backlog int, reopened_tickets int, utilization_rate double, sla_breaches int, "
        "resolution_rate double",
        ("date_id", "department_id"),
        partition="date_id",
    ),
    "fact_billing": Table(
        "billing_id long, date_id date, customer_id long, facility_id long, "
        "billed_amount double, consumption_m3 double, payment_status string, days_late short, "
        "discount_applied double, payment_method string",
        ("date_id", "customer_id"),
        partition="date_id",
    ),
    "fact_backlog": Table(
        "backlog_id long, ticket_id long, date_id date, customer_id long, facility_id long, "
        "department_id long, agent_id long, issue_category string, issue_channel string, "
        "priority string, backlog_status string, days_in_backlog int, "
        "backlog_age_category string, assigned_date date, expected_resolution_date date, "
        "last_updated date, sla_breached short, escalation_level short, reopened_count short, "
        "customer_segment string, tariff_category string, district string, "
        "backlog_reason string, resolution_notes string",
        ("date_id", "backlog_status", "priority", "ticket_id"),
        partition="date_id",
        defaults={
            "backlog_status": "Pending",
            "last_updated": TODAY,
            "sla_breached": 0,
            "escalation_level": 0,
            "reopened_count": 0,
            "backlog_reason": "",
            "resolution_notes": "",
        },
    ),
    "fact_agent_burnout_prediction": Table(
        "prediction_id long, date_id date, agent_id long, burnout_risk_score double, "
        "productivity_index double, risk_category string, risk_category_encoded short, "
        "current_utilization double, current_backlog int, current_escalation_rate double, "
        "current_sla_breaches int, current_stress_index double, "
        "current_handle_time_mins double, current_total_tickets int, "
        "current_reopened_tickets int, avg_utilization_7d double, avg_handle_time_7d double, "
        "avg_backlog_7d double, avg_utilization_30d double, avg_handle_time_30d double, "
        "avg_backlog_30d double, utilization_trend double, escalation_trend double, "
        "performance_declining short, persistent_backlog short, workload_velocity double, "
        "recommended_action string, workload_reduction_pct short, model_version string, "
        "confidence_score double",
        ("date_id", "agent_id", "prediction_id"),
        partition="date_id",
        defaults={"model_version": "v1.0_forest"},
        bloom=("risk_category", "risk_category_encoded"),
    ),
    "meas_executive_summary": Table(
        "measure_id long, measure_name string, measure_value double, measure_date date",
        ("measure_id",),
        defaults={"measure_date": TODAY},
    ),
    "meas_customer_service": Table(
        "measure_id long, measure_name string, measure_value double, measure_date date, "
        "district string, issue_category string",
        ("measure_id",),
        defaults={"measure_date": TODAY, "district": "", "issue_category": ""},
    ),
    "meas_agent_performance": Table(
        "measure_id long, agent_id long, measure_name string, measure_value double, "
        "measure_date date",
        ("measure_id",),
        defaults={"measure_date": TODAY},
    ),
    "meas_billing": Table(
        "measure_id long, measure_name string, measure_value double, measure_date date, "
        "customer_segment string",
        ("measure_id",),
        defaults={"measure_date": TODAY, "customer_segment": ""},
    ),
    "meas_resolution_rate_drilldown": _drilldown("Overall Resolution Rate %"),
    "meas_csat_drilldown": _drilldown("Overall CSAT Score"),
    "meas_sla_compliance_drilldown": _drilldown("Overall SLA Compliance %"),
    "meas_avg_resolution_time_drilldown": _drilldown("Overall Avg Resolution Time"),
    "meas_predictive": Table(
        "measure_id long, customer_id long, measure_name string, measure_value double, "
        "prediction_date date",
        ("measure_id",),
        defaults={"prediction_date": TODAY},
    ),
}

def _sums(keys: str, sums: str, dated: bool = True) -> Table:
    """Mergeable sums per key (and day); all of them are whole numbers."""
    columns = ", ".join(f"{name} long" for name in sums.split())
    names = tuple(part.split()[0] for part in keys.split(", "))
    head = "date_id date, " if dated else ""
    return Table(f"{head}{keys}, {columns}", (("date_id",) if dated else ()) + names, partition="date_id" if dated else None)


# Sums that the measures are made of: per day and key, and over all days for keys without a day.
_BY_AGENT = ("agent_id long", "n minutes escalated resolved used days")
_BY_CUSTOMER = ("customer_id long, issue_category string", "csat rated first met nps effort efforts response n")
_BY_PAYER = ("customer_id long", "billed consumption paid overdue discount n late paid_bills")
PARTS: dict[str, Table] = {
    "part_performance_department": _sums("department_id long", "resolved handled"),
    "part_tickets_department": _sums("department_id long", "csat rated hours timed met judged nps"),
    "part_backlog_department": _sums("department_id long", "met judged"),
    "part_performance_agent": _sums(*_BY_AGENT),
    "part_tickets_customer": _sums(*_BY_CUSTOMER),
    "part_billing_customer": _sums(*_BY_PAYER),
    "total_performance_agent": _sums(*_BY_AGENT, dated=False),
    "total_tickets_customer": _sums(*_BY_CUSTOMER, dated=False),
    "total_billing_customer": _sums(*_BY_PAYER, dated=False),
    "part_billing_day": Table("date_id date, billed long", ("date_id",), partition="date_id"),
    # What is distinct in a day, as sketches that merge over any days.
    "part_entities": Table(
        "date_id date, entity string, sketch binary", ("date_id", "entity"), partition="date_id"
    ),
}

# The nested layout of one sensor event.
EVENT_SCHEMA = (
    "event_id string, timestamp timestamp, "
    "facility struct<name: string, type: string, district: string, capacity_mld: double, "
    "location: struct<latitude: double, longitude: double>, supply_chain: string, "
    "upstream_facility: string, downstream_facility: string>, "
    "sensors map<string, struct<value: double, unit: string, status: string, "
    "threshold_min: double, threshold_max: double>>, "
    "operational_metrics struct<status: string, alert_level: int, active_sensors: int, "
    "uptime_percentage: double>, "
    "metadata struct<device_id: string, firmware_version: string, battery_level: double, "
    "network_signal: double>"
)

EVENT_FIELDS = (
    "event_id", "timestamp", "facility", "sensors", "operational_metrics", "metadata"
)

# The layout of the network configuration document.
CONFIG_SCHEMA = (
    "facilities map<string, struct<location: struct<latitude: double, longitude: double>, "
    "type: string, capacity_mld: double, district: string, supply_chain: string, "
    "upstream_facility: string, downstream_facility: string, priority_sensors: array<string>>>, "
    "sensors map<string, struct<unit: string, normal_range: array<double>, "
    "critical_low: double, critical_high: double, anomaly_chance: double, "
    "facility_types: array<string>, analytics_category: string>>"
)
