"""The registered queries, by module."""

from ledgerline.plans import joining, metrics, partitions, preparation, sources, streams, validation  # noqa: F401
