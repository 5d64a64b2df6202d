"""Code values used by the decision chains.

The numeric codes of sources, widget types and statuses are configuration:
the job this library re-expresses imports them from a package it does not
ship. The defaults below are our own and follow three rules: source codes are
distinct and > 0 (0 means "none"), the default id is 0, and the company-site
widget type is 0 (so the literal-0 join key of the widget-type lookup can
match).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Codes:
    # apply sources (lead.source)
    company_page: int = 1
    sms: int = 2
    widget: int = 3
    whatsapp: int = 4
    add_manually: int = 5
    outbound: int = 6
    public_api: int = 7
    campaign: int = 8
    browser_extension: int = 9
    landing_site: int = 10
    erp_page: int = 11
    scheduler_page: int = 12
    # extra apply sources (derived codes)
    x_referred_by: int = 101
    x_event: int = 102
    x_landing_site: int = 103
    x_job_posting_site: int = 104
    # apply types
    apply_type_event: int = 1
    # widget types
    wt_company_site: int = 0
    wt_erp_site: int = 1
    wt_schedule: int = 2
    wt_company_additional: int = 3
    wt_job_posting: int = 4
    # lead status / common
    status_removed: int = 9
    default_id: int = 0
    # sources whose name comes from the widget
    widget_sources: tuple[int, ...] = (1, 3, 10, 11, 12)
    # external system code -> display name
    ats_names: dict[str, str] = field(default_factory=lambda: {"A": "Alpha ATS", "B": "Beta ATS"})

    @property
    def lookup_widget_types(self) -> tuple[int, int, int]:
        return (self.wt_company_site, self.wt_erp_site, self.wt_schedule)


DEFAULT_CODES = Codes()

# Fixed values that must equal the original job's for matching results.
# Literal texts compared or emitted by the job:
NAME_TEST_PATTERN = "%test%"
NAME_UNKNOWN_PATTERN = "%unknown%"
SOURCE_FILTER_TEST_PATTERN = "%Test%"
SOURCE_FILTER_UNKNOWN_PREFIX = "Unknow%"
JOURNEY_MODULE = "JOURNEY"
JOURNEY_COMPLETE_ACTION = "Capture: Capture Complete"
APPLICATION_PERIOD_START = "2021-07-01"
INTERNAL_FEED_JSON_PATH = "$.is_internal_job_feed"
CUSTOM_ORG_KEY = "cf_custom_org"
REFERRED_BY_PREFIX = "Referred by "
ADDED_BY_PREFIX = "Added by "
EVENT_LANDING_PAGE = "Event Landing Page"
