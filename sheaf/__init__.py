"""sheaf: document structuring and analytics as Spark plans."""
