"""DataFrame -> DataFrame operators over typed log rows."""
