"""DataFrame -> DataFrame tag operators."""
