"""Reading folders of files: listings, schemas, checks and typed frames."""
