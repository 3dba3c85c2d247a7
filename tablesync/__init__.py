"""Copy tables and views between catalogs on Spark, and prove that the copy is right."""
