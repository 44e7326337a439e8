"""DataFrame-to-DataFrame steps shared by the plans."""
