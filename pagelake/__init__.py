"""pagelake: document-layout analytics expressed as Spark DataFrame transforms."""
