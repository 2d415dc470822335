"""Customer metrics as Spark DataFrame operators.

Sales orders and sales items go in; one wide profile row per recently active
customer comes out, joined with contact e-mails, cut into fixed-size batches
and serialised as one JSON payload per batch.  Every step is a pure
``DataFrame -> DataFrame`` function built from Spark's own expressions.
"""

from clientele.operators.batching import assign_batches
from clientele.operators.contacts import contact_table, recent_customer_emails
from clientele.operators.events import last_event
from clientele.operators.export import contact_export, contact_payloads, write_payloads
from clientele.operators.facts import flag_items, item_facts
from clientele.operators.habits import favourite_bucket
from clientele.operators.metrics import active_customers, customer_metrics, customer_profile
from clientele.plans.contact_job import build_contacts, run_contact_export
from clientele.sources.tables import read_jdbc_table, read_table, save_bucketed

__all__ = [
    "active_customers",
    "assign_batches",
    "build_contacts",
    "contact_export",
    "contact_payloads",
    "contact_table",
    "customer_metrics",
    "customer_profile",
    "favourite_bucket",
    "flag_items",
    "item_facts",
    "last_event",
    "read_jdbc_table",
    "read_table",
    "recent_customer_emails",
    "run_contact_export",
    "save_bucketed",
    "write_payloads",
]
