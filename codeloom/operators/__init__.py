"""DataFrame -> DataFrame operators (dictionary, codes, matching, allocation, reports, web)."""
