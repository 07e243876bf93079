"""Every operator as a query over the test tables, with the SQL it must agree with."""

from . import access, corpus, index, reports, sampling, tokens
from .registry import Registry

REGISTRY = Registry()
for module in (corpus, tokens, index, access, sampling, reports):
    module.register(REGISTRY)
