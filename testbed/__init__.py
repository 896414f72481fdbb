"""Driver tables in the roles of the library's inputs. Not part of the library."""
