"""DataFrame operators: joins, merges, outlier bounds, screening, nearest neighbours."""
