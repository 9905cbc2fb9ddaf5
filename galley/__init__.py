"""galley: DataFrame operators for content migration and entity resolution."""
