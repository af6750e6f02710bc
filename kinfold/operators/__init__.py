"""Record-linkage operators over DataFrames."""
