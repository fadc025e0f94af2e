"""DataFrame -> DataFrame operators."""

from lakecheck.operators import dims, facts, numbering, quality, recon, results

__all__ = ["dims", "facts", "numbering", "quality", "recon", "results"]
