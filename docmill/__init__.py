"""docmill: document analytics and document ETL as Spark jobs."""
