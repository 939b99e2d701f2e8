"""The registry that the modules of this subpackage share."""

from __future__ import annotations

from millrace.plans.registry import Registry

R = Registry()
