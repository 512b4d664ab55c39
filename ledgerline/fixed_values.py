"""Values that results depend on and that cannot be chosen freely."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: filings feed -------------------------------------------------------------------

# Title of a feed entry: form type, company, entity id, role. Every group is greedy.
# (?d): only a line feed ends a line, as in the feed's own consumers.
TITLE_PATTERN = r"(?d)(.*) - (.*) \((.*)\) \((.*)\)"
ENTRY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
FEED_PAGE_SIZE = 10

# --- Fixed values: landing pages ------------------------------------------------------------------

SITE_BASE = "https://www.sec.gov"
PAGE_OK_STATUSES = (200, 201, 202)
DOCUMENT_TABLE_TAG = "table"
DOCUMENT_TABLE_CLASS = "tableFile"
DOCUMENT_TABLE_SUMMARY = "Document Format Files"


@dataclass(frozen=True)
class Route:
    """Destination of one exact form type."""

    form_type: str
    name: str
    title: str


# --- Fixed values: form types that are routed, with the title of their messages ---------------------

ROUTES = (
    Route("8-K", "8k", "8-K filings from SEC RSS"),
    Route("10-K", "10k", "10-K filings from SEC RSS"),
)

# --- Fixed values: tags -----------------------------------------------------------------------------

TAG_KEYS = (
    "Provisioned_By",
    "LOB",
    "Role",
    "Environment",
    "Application",
    "Business_Service",
    "Patch_Level",
    "Backup",
    "Monitoring_Strategy",
)

# Keys a user may have set on a resource already; their value then replaces the default.
# "Backup" has no constant default: it follows from the environment.
TAG_DEFAULTS = {
    "Application": "",
    "Business_Service": "",
    "Patch_Level": "MIT",
    "Backup": None,
    "Monitoring_Strategy": "Persistent",
}
BACKUP_BY_ENVIRONMENT = {"PRD": "monthly"}
IAM_USER_TYPE = "IAMUser"
IAM_USER_ROLE = "IAM_USER"

# --- Fixed values: requests -------------------------------------------------------------------------

NOTIFICATION_TEMPLATE = "FilingsTemplate"
RENDER_NAME_FORMAT = "%s-%s-%s.pdf"
MISSING_HTML_MESSAGE = "Validation error: Missing field 'html'."
SUMMARY_FORMAT = "Finished downloading for %d companies."


@dataclass(frozen=True)
class AliasRule:
    """If an account alias contains ``token``, it is known; ``strip`` removes every occurrence."""

    token: str
    strip: bool


# --- Fixed values: account alias tokens, first match wins -------------------------------------------

ALIAS_RULES = (AliasRule("ma-", True), AliasRule("mit-", False))


def alias_rules(organisation: str | None = None) -> tuple[AliasRule, ...]:
    """The alias rules; an organisation's own name prefix, if it has one, comes last and is removed."""
    return ALIAS_RULES + ((AliasRule(organisation, True),) if organisation else ())


@dataclass(frozen=True)
class EventRule:
    """Where an audit event names the resources it created.

    ``field`` is looked up in ``detail``'s ``parent``. It holds an id or, if ``item`` is set, an object with
    a list ``items`` of objects whose ``item`` is an id. ``children`` are the attachment kinds tagged along
    with each resource; ``via`` replaces each named id by the attached resource of that kind first.
    """

    event_name: str
    resource_class: str
    field: str
    parent: str = "responseElements"
    item: str | None = None
    reads_tags: bool = False
    children: tuple[str, ...] = ()
    via: str | None = None


# --- Fixed values: supported audit events -----------------------------------------------------------

EVENT_RULES = (
    EventRule("CreateVolume", "ids", "volumeId", reads_tags=True),
    EventRule("RunInstances", "ids", "instancesSet", item="instanceId",
              reads_tags=True, children=("volume", "interface")),
    EventRule("RequestSpotInstances", "ids", "spotInstanceRequestSet",
              item="spotInstanceRequestId", reads_tags=True, children=("volume", "interface"), via="spot"),
    EventRule("CreateImage", "ids", "imageId", children=("snapshot",)),
    EventRule("CreateSnapshot", "ids", "snapshotId"),
    EventRule("CreateInternetGateway", "ids", "internetGatewayId"),
    EventRule("CreateSecurityGroup", "ids", "groupId"),
    EventRule("CreateVpc", "ids", "vpcId"),
    EventRule("CreateSubnet", "ids", "subnetId"),
    EventRule("CreateRouteTable", "ids", "routeTableId"),
    EventRule("CreateNetworkAcl", "ids", "networkAclId"),
    EventRule("CreateNatGateway", "ids", "natGatewayId"),
    EventRule("CreateCustomerGateway", "ids", "customerGatewayId"),
    EventRule("CreateVpnGateway", "ids", "vpnGatewayId"),
    EventRule("CreateVpnConnection", "ids", "vpnConnectionId"),
    EventRule("CreateDBInstance", "db", "dBInstanceArn", reads_tags=True),
    EventRule("CreateDBSnapshot", "db", "dBSnapshotArn", reads_tags=True),
    EventRule("CreateDBCluster", "db", "dBClusterArn", reads_tags=True),
    EventRule("CreateDBClusterParameterGroup", "db", "dBClusterParameterGroupArn", reads_tags=True),
    EventRule("CreateDBClusterSnapshot", "db", "dBClusterSnapshotArn", reads_tags=True),
    EventRule("CreateDBInstanceReadReplica", "db", "dBInstanceArn", reads_tags=True),
    EventRule("CreateDBParameterGroup", "db", "dBParameterGroupArn", reads_tags=True),
    EventRule("CreateDBSecurityGroup", "db", "dBSecurityGroupArn", reads_tags=True),
    EventRule("CreateDBSubnetGroup", "db", "dBSubnetGroupArn", reads_tags=True),
    EventRule("CreateEventSubscription", "db", "eventSubscriptionArn", reads_tags=True),
    EventRule("CreateOptionGroup", "db", "optionGroupArn", reads_tags=True),
    EventRule("CreateBucket", "bucket", "bucketName", parent="requestParameters"),
)
