"""What to extract: ``TableSpec`` rows and the reference's manifest as data.

A job is a list of ``TableSpec``.  Each spec names a source, a schema and
a table, how to read it (``Extract``), where to write it (``Layout``) and
the options of the reference's extracts: column list, derived column,
window, parent link, ``distinct`` and clean-up.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from enum import Enum

from ..functions.windows import CREATION_FLOOR, INSERT_CUTOFF, LOG_CREATION_LOOKBACK_MONTHS, OPPORTUNITY_YEARS, POLL_CUTOFF
from ..sinks.paths import Layout, folder_for_schema


class Extract(str, Enum):
    SNAPSHOT = "snapshot"            # S1 (+ P2/P4): whole table
    SEMI_STATIC = "semi_static"      # J1: child of parents above a floor
    WINDOW = "window"                # S2 with F1-F5 / F9
    DISTINCT_KEYS = "distinct_keys"  # A2 + F6
    INCREMENT = "increment"          # S7 + F7/F8 (+ A1, P2): parent delta
    CASCADE = "cascade"              # J2-J4: children of the parent delta
    RECORDS = "records"              # S6 + P3 + P5 (+ F9)


@dataclass(frozen=True)
class Window:
    """A window predicate."""

    kind: str  # month_to_date | month_to_date_epoch | rolling_update | created_since | last_n_years
    column: str = "created_at"
    created: str = "created_at"
    cutoff: dt.time = INSERT_CUTOFF
    days: int = 3
    floor: dt.datetime | None = CREATION_FLOOR
    floor_months: int | None = None
    years: int = OPPORTUNITY_YEARS


@dataclass(frozen=True)
class TableSpec:
    job: str                     # full | insert_update | incremental | records
    source: str
    schema: str
    table: str
    extract: Extract
    layout: Layout
    folder: str = ""
    columns: tuple[str, ...] | None = None
    derived: tuple[tuple[str, str], ...] = ()    # (name, SQL expression)
    derived_in_source: bool = False              # evaluate in the JDBC source (X9)
    window: Window | None = None
    key: str = "id"                              # A2 key, or the parent key of children
    parent: str | None = None
    parent_window: Window | None = None          # J1 parent filter
    child_key: str | None = None
    own_delta: bool = False                      # J3
    distinct: bool = False                       # A1
    unique_key: tuple[str, ...] | None = None    # columns known unique: A1 is then a no-op
    consistent_read: bool = False                # jdbc: one connection, one snapshot (no parallel ranges)
    sanitize: bool = True                        # X1/X2 reach the file
    created: str = "created_at"
    updated: str = "updated_at"
    update_floor: dt.datetime | None = None      # F8
    target_source: str | None = None             # S7 warehouse holding the target copy
    target_table: str | None = None
    output_name: str | None = None               # P6
    record_schema: str | None = None             # DDL of landed records; None = text fields
    single_file: bool = False
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def name(self) -> str:
        return self.output_name or self.table

    def out_folder(self) -> str:
        return self.folder or folder_for_schema(self.schema)

    def but(self, **changes) -> "TableSpec":
        return replace(self, **changes)


# ---------------------------------------------------------------------------
# The reference's table lists, column list and CRM field lists,
# in the reference's order.

SMC_SNAPSHOT_TABLES = (
    "customer, bb_instance, bb_device, bb_history, circuit, circuit_status, circuit_protocol_type, "
    "circuit_transport_type, location, sales_account_manager, sf_guard_user_profile, asset, asset_ip_info, "
    "billed_lineitem_status, billed_status, contract_type, delivery, delivery_budget, delivery_contact, "
    "delivery_lineitem_status, delivery_status, order_type, phase, product, product_category, project_complexity, "
    "quote, quote_group_market_impact, quote_location, region, sf_guard_user, user_productivity, "
    "delivery_report_lineitem_status, asset_alias, asset_audit, asset_break_fix_vendor, asset_disposal_reason, "
    "asset_ip_type, asset_managed_by, asset_manufacturer, asset_model, asset_os_type, asset_patch_engineer, "
    "asset_patch_night, asset_pod, asset_status, asset_type, app, auto_watch, auto_watch_asset, auto_watch_category, "
    "auto_watch_problem, auto_watch_service, auto_watch_user, business_service, business_service_product, cabinet, "
    "cadence_log, category, change_asset, change_control, change_customer, change_status, change_type, "
    "customer_business_service, customer_region, customer_resource_link, customer_user, customer_type, department, "
    "facility, incident, incident_asset, incident_customer, incident_facility, incident_impact, incident_status, "
    "note_file, notification_type, object_tag, phone_number, position_history, problem, queue, queue_user, role, "
    "root_cause, sales_market, scheduled_visit, scheduled_visit_visitor, severity, sub_problem, survey_clicks, tag, "
    "task, tfa, ticket_source, ticket_status, visibility, visit, visit_location, visit_purpose, zerto_vpg, zerto_zvm, "
    "quote_group, term_type, ticket_delivery, contract"
)
VCENTER_TABLES = "resource_pool, virtual_center, virtual_cluster, virtual_datacenter, virtual_machine"
CALL_METRICS_TABLES = (
    "abandoned_call_detail_activity, agent_call_summary, agent_state_summary, agent_summary, "
    "contact_service_queue_activity, contact_service_queue_activity_by_csq, csq_agent_summary"
)
SHIFT_REPORT_TABLES = "data_center, key_list, key_log, key_name, walk, walk_element, walk_instance, walk_section"
INCREMENT_PARENTS = "ASSET, CHANGE_CONTROL, INCIDENT, TASK, TICKET"

TICKET_COLUMNS = (
    "id, status_id, source_id, visibility_id, severity_id, queue_id, customer_id, category_id, problem_id, "
    "problem_template_id, template_id, subject, address, hold_end_at, time_held, ttr, ttc, is_escalated, is_phone, "
    "created_by, updated_by, assigned_to, reopened_by, held_by, resolved_by, closed_by, created_at, updated_at, "
    "internal_updated_at, update_due_at, close_due_at, assigned_at, moved_at, reopened_at, held_at, resolved_at, "
    "closed_at, vantive_id, ticket_scheduler_id, ticket_template_id, legacy_id, legacy_system_id, is_survey_accessed, "
    "close_out_at, is_awaiting_response, acknowledgement, acknowledged_at, is_master_outage, "
    "escalate_for_review_start_at, is_lync, hold_reason_id, sub_problem_id, helpful_yes_count, helpful_no_count, "
    "helpful_neutral_count, root_cause_id, root_cause_other, parent_ticket_scheduler_id, max_severity_id, metadata"
)

# Source-side function of the derived column (its body lives in the source).
NET_IMPACT_FUNCTION = "GetTotalImpactForLineitem"

# (output name, source object, fields, years window on CreatedDate or None)
CRM_OBJECTS = (
    ("Opportunity", "Opportunity",
     "Id, IsDeleted, AccountId, Name, Description, StageName, Amount, Probability, CloseDate, Type, NextStep, "
     "LeadSource, IsClosed, IsWon, ForecastCategory, ForecastCategoryName, CampaignId, OwnerId, CreatedDate, "
     "CreatedById, LastModifiedDate, LastModifiedById, LastActivityDate, LastStageChangeDate, ContactId, "
     "External_Account__c, External_Account_Id__c, External_Id__c, External_Opportunity_Id__c, External_Owner__c, "
     "External_Process_Id__c, Primary_Solution_Location__c, QT_Link__c, QT_MRC_Margin__c, QT_MRR__c, "
     "QT_Months_Until_Profit__c, QT_NRC_Margin__c, QT_NRR__c, QuoteTrackerID__c, Contract_Type__c, "
     "Primary_Datacenter__c, Quote_Tracker_ID__c, QT_Net_Impact__c, Revision_Number__c, Area_to_Improve__c, "
     "Backup__c, Facility_Network__c, First_Account_Opportunity__c, High_Density_Datacenter__c, "
     "Initial_Quote_Created_At__c, Internet__c, Managed_SAN__c, Monitoring__c, NRR__c, nServer__c, Replacement__c, "
     "Services__c, Term__c, Workplace__c, Partner_Account__c, Partner_Contact__c",
     OPPORTUNITY_YEARS),
    ("Account", "Account",
     "Id, IsDeleted, MasterRecordId, Name, Type, RecordTypeId, ParentId, Phone, Fax, AccountNumber, Website, "
     "PhotoUrl, Sic, Industry, AnnualRevenue, NumberOfEmployees, Ownership, TickerSymbol, Rating, Site, OwnerId, "
     "CreatedDate, CreatedById, LastModifiedDate, LastModifiedById, SystemModstamp, LastActivityDate, "
     "LastViewedDate, LastReferencedDate, IsPartner, IsCustomerPortal, Lead_Source__c, Customer_Status__c, "
     "Customer_Type__c, QuoteTrackerID__c, Contract_Name__c, QuoteTrackerID_for_url__c, Contract_effective_date__c, "
     "Contract_End_Date__c, Auto_Renew_Term__c, MRR_Last_Updated__c, Customer_Tracker_ID__c",
     None),
    ("User", "User",
     "Id, FirstName, LastName, Division, IsActive, ReceivesAdminInfoEmails, Alias, ForecastEnabled, MobilePhone, "
     "CompanyName, Department, Email, EmailEncodingKey, EmployeeNumber, Extension, Fax, ReceivesInfoEmails, "
     "LanguageLocaleKey, LocaleSidKey, ManagerId, NAME, CommunityNickname, Phone, ProfileId, UserRoleId, "
     "FederationIdentifier, TimeZoneSidKey, Title, Username, ContactID, PortalRole, AccountID, CreatedDate",
     None),
    ("OpportunityTeamMember", "OpportunityTeamMember",
     "Id, OpportunityAccessLevel, OpportunityId, TeamMemberRole, UserId, CreatedDate, IsDeleted",
     None),
    ("RelatedPartner", "Related_Partners__c",
     "Id, OwnerId, IsDeleted, Name, CreatedDate, CreatedById, LastModifiedDate, LastModifiedById, SystemModstamp, "
     "LastActivityDate, LastViewedDate, LastReferencedDate, ConnectionReceivedId, ConnectionSentId, Account__c, "
     "Related_Partners_ID__c, Partner__c, Master_Agent_Owner__c, Assigned_PAE__c, Sub_Agent__c, "
     "If_Other_Sub_Agent_Please_Specify__c, Primary_Solution_Type__c, Partner_Lead_Status__c, "
     "Partner_Lead_Submission_Date_del__c",
     None),
    ("AccountTeamMember", "AccountTeamMember",
     "Id, AccountId, UserId, TeamMemberRole, PhotoUrl, Title, AccountAccessLevel, OpportunityAccessLevel, "
     "CaseAccessLevel, ContactAccessLevel, CreatedDate, CreatedById, LastModifiedDate, LastModifiedById, "
     "SystemModstamp, IsDeleted",
     None),
)


def names(text: str) -> tuple[str, ...]:
    """Split a comma-separated fixed list."""
    return tuple(n.strip() for n in text.split(",") if n.strip())


# ---------------------------------------------------------------------------
# The reference's four jobs as manifests.  Source names are the schema names;
# callers bind each to a connection in a SourceRegistry.


def _snapshots(schema: str, tables: str, sanitize: bool = True) -> list[TableSpec]:
    return [TableSpec("full", schema, schema, t, Extract.SNAPSHOT, Layout.SNAPSHOT, sanitize=sanitize)
            for t in names(tables)]


def full_load_manifest() -> list[TableSpec]:
    """G1: 135 whole-table snapshots.  Where the reference writes before the
    clean-up runs, ``sanitize`` is False (its clean frame is discarded)."""
    specs = _snapshots("smc", SMC_SNAPSHOT_TABLES)
    specs.append(TableSpec("full", "smc", "smc", "ticket_asset", Extract.SEMI_STATIC, Layout.SNAPSHOT,
                           parent="ticket", child_key="ticket_id", key="id",
                           parent_window=Window("created_since", column="created_at", floor=CREATION_FLOOR)))
    specs.append(TableSpec("full", "smc", "smc", "delivery_lineitem", Extract.SNAPSHOT, Layout.SNAPSHOT,
                           derived=(("net_impact", f"{NET_IMPACT_FUNCTION}(lineitem_id, quantity)"),),
                           derived_in_source=True))
    specs.append(TableSpec("full", "smc", "smc", "lineitem", Extract.SNAPSHOT, Layout.SNAPSHOT,
                           derived=(("net_impact", f"{NET_IMPACT_FUNCTION}(id, quantity)"),),
                           derived_in_source=True))
    specs += _snapshots("billing-service", "account")
    specs += _snapshots("sslvpn", "tblVSAs")
    specs += _snapshots("vcoloburst", "vcoloburst", sanitize=False)
    specs += _snapshots("vcenter-new", VCENTER_TABLES, sanitize=False)
    specs += _snapshots("call_metrics", CALL_METRICS_TABLES, sanitize=False)
    specs += _snapshots("shift_report", SHIFT_REPORT_TABLES, sanitize=False)
    specs += _snapshots("power-etl", "power_utilizations", sanitize=False)
    return specs


def insert_update_manifest() -> list[TableSpec]:
    """11 windowed extracts."""
    mtd = Window("month_to_date", column="created_at")
    ticket_cols = names(TICKET_COLUMNS)
    iu = "insert_update"
    return [
        TableSpec(iu, "smc", "smc", "note", Extract.WINDOW, Layout.INSERT, window=mtd),
        TableSpec(iu, "smc", "smc", "note", Extract.WINDOW, Layout.UPDATE,
                  window=Window("rolling_update", column="updated_at", created="created_at", floor=CREATION_FLOOR)),
        TableSpec(iu, "smc", "smc", "note", Extract.DISTINCT_KEYS, Layout.DISTINCT, key="id",
                  window=Window("created_since", column="created_at", floor=CREATION_FLOOR)),
        TableSpec(iu, "smc", "smc", "log", Extract.WINDOW, Layout.INSERT, window=mtd),
        TableSpec(iu, "smc", "smc", "log", Extract.WINDOW, Layout.UPDATE,
                  window=Window("rolling_update", column="updated_at", created="created_at", floor=None,
                                floor_months=LOG_CREATION_LOOKBACK_MONTHS)),
        TableSpec(iu, "smc", "smc", "ticket", Extract.WINDOW, Layout.INSERT, window=mtd, columns=ticket_cols),
        TableSpec(iu, "smc", "smc", "ticket", Extract.WINDOW, Layout.UPDATE, columns=ticket_cols,
                  window=Window("rolling_update", column="updated_at", created="created_at", floor=CREATION_FLOOR)),
        TableSpec(iu, "sslvpn", "sslvpn", "tblTransactions", Extract.WINDOW, Layout.SNAPSHOT, sanitize=False,
                  window=Window("month_to_date_epoch", column="unixdate")),
        TableSpec(iu, "vcoloburst", "vcoloburst", "poll_data", Extract.WINDOW, Layout.SNAPSHOT, sanitize=False,
                  window=Window("month_to_date", column="poll_timestamp", cutoff=POLL_CUTOFF)),
        TableSpec(iu, "call_metrics", "call_metrics", "call_csq_agent", Extract.WINDOW, Layout.INSERT, window=mtd),
        TableSpec(iu, "shift_report", "shift_report", "walk_result", Extract.WINDOW, Layout.INSERT, window=mtd),
    ]


def incremental_manifest(warehouse: str = "warehouse") -> list[TableSpec]:
    """Five parents on the warehouse's marks and their children.
    Warehouse names are upper case; sources and paths use lower case."""
    inc = "incremental"
    specs = []
    for upper in names(INCREMENT_PARENTS):
        lower = upper.lower()
        is_ticket = lower == "ticket"
        specs.append(TableSpec(
            inc, "smc", "smc", lower, Extract.INCREMENT, Layout.DAILY_INCR,
            columns=names(TICKET_COLUMNS) if is_ticket else None,
            distinct=not is_ticket,
            update_floor=CREATION_FLOOR if is_ticket else None,
            target_source=warehouse, target_table=upper))
    children = (
        ("asset", "ASSET_IP_INFO", "asset_id", True),
        ("change_control", "CHANGE_ASSET", "change_id", False),
        ("change_control", "CHANGE_CUSTOMER", "change_id", False),
        ("incident", "INCIDENT_ASSET", "incident_id", False),
        ("incident", "INCIDENT_CUSTOMER", "incident_id", False),
        ("incident", "INCIDENT_FACILITY", "incident_id", False),
        ("ticket", "TICKET_ASSET", "ticket_id", False),
    )
    for parent, upper, child_key, own in children:
        specs.append(TableSpec(
            inc, "smc", "smc", upper.lower(), Extract.CASCADE, Layout.DAILY_INCR,
            parent=parent, child_key=child_key, key="id", own_delta=own, distinct=True,
            target_source=warehouse, target_table=upper))
    return specs


def records_manifest(source: str = "crm") -> list[TableSpec]:
    """Six CRM objects; ``Opportunity`` keeps the last three years."""
    specs = []
    for output, obj, fields, years in CRM_OBJECTS:
        window = Window("last_n_years", column="CreatedDate", years=years, floor=None) if years else None
        specs.append(TableSpec("records", source, source, obj, Extract.RECORDS, Layout.RECORDS,
                               columns=names(fields), window=window, output_name=output))
    return specs


def reference_manifest() -> list[TableSpec]:
    return full_load_manifest() + insert_update_manifest() + incremental_manifest() + records_manifest()
