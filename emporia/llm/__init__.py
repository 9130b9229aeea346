"""Training-data operators: one module per operator, plus their query registry.

Nothing outside this subpackage imports it; the driver entry adds its queries
only when it is present.
"""
