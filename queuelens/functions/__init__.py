"""Native column expressions: timestamp parsing, SLA measures, derived keys."""

from queuelens.functions import privacy, sla, text, timestamps  # noqa: F401
